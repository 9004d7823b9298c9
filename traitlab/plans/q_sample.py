"""Queries for sampling, splitting and balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators import sample as B
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles

D = O.det_sql()


def _labelled_ctes():
    return [f"dim AS ({O.countries_values()})", "rl AS (SELECT c.*, coalesce(d.region, 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country)"]


def _b01_sql():
    return O.with_clean() + "SELECT row_id FROM " + O.first_rows_sql("clean", "floor(_cnt * 0.06)")


@register("b01_sample_frac", _b01_sql)
def b01_sample_frac(spark, sf_dir):
    return B.sample_frac(flows.clean_survey(spark, sf_dir), "row_id", 0.06).select("row_id")


def _b02_sql():
    return O.with_clean() + "SELECT row_id, o_score FROM " + O.first_rows_sql("clean", "100")


@register("b02_sample_n", _b02_sql)
def b02_sample_n(spark, sf_dir):
    return B.sample_n(flows.clean_survey(spark, sf_dir), "row_id", 100).select("row_id", "o_score")


def _b03_sql():
    return O.with_clean() + (
        f"SELECT row_id, CASE WHEN row_number() OVER (ORDER BY {D}, row_id) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM clean"
    )


@register("b03_split", _b03_sql)
def b03_split(spark, sf_dir):
    return B.split(flows.clean_survey(spark, sf_dir), "row_id", 0.2).select("row_id", "split")


def _b04_sql():
    return O.with_clean() + (
        f"SELECT row_id, country, CASE WHEN row_number() OVER (PARTITION BY country ORDER BY {D}, row_id) <= round(count(*) OVER (PARTITION BY country) * 0.2) "
        "THEN 'test' ELSE 'train' END AS split FROM clean"
    )


@register("b04_stratified_split", _b04_sql)
def b04_stratified_split(spark, sf_dir):
    return B.split(flows.clean_survey(spark, sf_dir), "row_id", 0.2, stratify="country").select("row_id", "country", "split")


def _b05_sql():
    return O.with_clean() + "SELECT row_id, country FROM " + O.first_rows_by_sql("clean", "country", "least(_cnt, 40)")


@register("b05_cap_classes", _b05_sql)
def b05_cap_classes(spark, sf_dir):
    return B.cap_classes(flows.clean_survey(spark, sf_dir), "country", "row_id", cap=40).select("row_id", "country")


def _b06_sql():
    return O.with_clean(
        *_labelled_ctes(),
        "cc AS (SELECT region_label, count(*) AS c FROM rl GROUP BY region_label)",
        "second AS (SELECT c FROM cc ORDER BY c DESC LIMIT 1 OFFSET 1)",
    ) + "SELECT row_id, region_label FROM " + O.first_rows_by_sql("rl", "region_label", "least(_cnt, (SELECT c FROM second))")


@register("b06_level_largest", _b06_sql)
def b06_level_largest(spark, sf_dir):
    return B.level_largest(flows.region_labelled(spark, sf_dir), "region_label", "row_id").select("row_id", "region_label")


def _b07_sql():
    return O.with_clean(*_labelled_ctes()) + (
        "SELECT row_id, region_label, round(count(*) OVER () / ((SELECT count(DISTINCT region_label) FROM rl) * count(*) OVER (PARTITION BY region_label)), 6) AS weight FROM rl"
    )


@register("b07_class_weights", _b07_sql)
def b07_class_weights(spark, sf_dir):
    return round_doubles(B.class_weights(flows.region_labelled(spark, sf_dir), "region_label").select("row_id", "region_label", "weight"))


def _b09_sql():
    return O.with_clean(*_labelled_ctes()) + "SELECT region_label, count(*) AS n FROM rl GROUP BY region_label"


@register("b09_class_counts", _b09_sql)
def b09_class_counts(spark, sf_dir):
    return B.class_counts(flows.region_labelled(spark, sf_dir), "region_label")


def _b10_sql():
    return O.with_clean() + f"SELECT row_id, CAST((row_number() OVER (ORDER BY {D}, row_id) - 1) % 3 AS INTEGER) AS fold FROM clean"


@register("b10_folds", _b10_sql)
def b10_folds(spark, sf_dir):
    return B.folds(flows.clean_survey(spark, sf_dir), "row_id", 3).select("row_id", "fold")


def _b10s_sql():
    return O.with_clean() + (
        f"SELECT row_id, country, CAST((row_number() OVER (PARTITION BY country ORDER BY {D}, row_id) - 1) % 3 AS INTEGER) AS fold FROM clean"
    )


@register("b10_stratified_folds", _b10s_sql)
def b10_stratified_folds(spark, sf_dir):
    return B.folds(flows.clean_survey(spark, sf_dir), "row_id", 3, stratify="country").select("row_id", "country", "fold")


def _b08_sql():
    return O.with_clean(
        f"rk AS (SELECT row_id, o_score, row_number() OVER (ORDER BY {D}, row_id) - 1 AS rank FROM clean)",
        "dr AS (SELECT CAST(CAST('0x' || substr(md5('42:' || CAST(j AS VARCHAR)), 1, 15) AS UBIGINT) % (SELECT count(*) FROM clean) AS BIGINT) AS rank FROM range(0, (SELECT count(*) FROM clean)) t(j))",
    ) + "SELECT row_id, o_score FROM dr JOIN rk USING (rank)"


@register("b08_bootstrap", _b08_sql)
def b08_bootstrap(spark, sf_dir):
    """n draws with replacement."""
    return B.bootstrap(flows.clean_survey(spark, sf_dir).select("row_id", "o_score"), "row_id", seed=42)


__all__ = ["F"]
