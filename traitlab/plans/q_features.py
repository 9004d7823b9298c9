"""Queries for feature transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators import features as FT
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.sources.dims import ITEMS, SCORES

REGIONS = ["Africa", "Americas", "Asia", "Europe", "Oceania", "nan"]


def _f01_sql():
    return O.with_clean(O.zs_cte()) + "SELECT row_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in O.ZSCORES) + " FROM zs"


@register("f01_standardize", _f01_sql)
def f01_standardize(spark, sf_dir):
    return round_doubles(flows.zscored_survey(spark, sf_dir).select("row_id", *flows.ZSCORES))


def _f02_sql():
    parts = ", ".join(f"round((({s} - min({s}) OVER ()) / (max({s}) OVER () - min({s}) OVER ())), 6) AS {s}_mm" for s in SCORES)
    return O.with_clean() + f"SELECT row_id, {parts} FROM clean"


@register("f02_minmax", _f02_sql)
def f02_minmax(spark, sf_dir):
    """Min-max over the whole table: the range is one global aggregate
    applied as literals (no unpartitioned window over rows)."""
    df = flows.clean_survey(spark, sf_dir).select("row_id", *SCORES)
    return round_doubles(FT.minmax(df, SCORES, suffix="_mm").select("row_id", *[f"{s}_mm" for s in SCORES]))


def _f03_sql():
    return O.with_clean(f"dim AS ({O.countries_values()})") + (
        "SELECT row_id, region_label, CAST(dense_rank() OVER (ORDER BY region_label) - 1 AS INTEGER) AS region_code FROM "
        "(SELECT c.row_id, coalesce(d.region, 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country) t"
    )


@register("f03_encode_labels", _f03_sql)
def f03_encode_labels(spark, sf_dir):
    df, _ = FT.encode_labels(flows.region_labelled(spark, sf_dir), "region_label", out="region_code")
    return df.select("row_id", "region_label", "region_code")


def _f04_sql():
    cols = ", ".join(f'CAST(region_label = {O.q(r)} AS DOUBLE) AS "is_{r}"' for r in REGIONS)
    return O.with_clean(f"dim AS ({O.countries_values()})") + (
        f"SELECT row_id, {cols} FROM (SELECT c.row_id, coalesce(d.region, 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country) t"
    )


@register("f04_one_hot", _f04_sql)
def f04_one_hot(spark, sf_dir):
    df = flows.region_labelled(spark, sf_dir)
    _, lm = FT.encode_labels(df, "region_label")
    return FT.one_hot(df, "region_label", lm.labels).select("row_id", *[f"is_{c}" for c in lm.labels])


def _f05m_sql():
    pairs = [(a, b) for i, a in enumerate(SCORES) for j, b in enumerate(SCORES)]
    sel = " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, round(covar_pop({a}, {b}), 6) AS cov FROM clean" for a, b in pairs)
    return O.with_clean() + sel


@register("f05_moments", _f05m_sql)
def f05_moments(spark, sf_dir):
    """The data pass of factor analysis: population covariance matrix."""
    return round_doubles(FT.covariance_long(flows.clean_survey(spark, sf_dir), SCORES))


@register("f05_factor_scores")
def f05_factor_scores(spark, sf_dir):
    """Rows-only: five factor scores from the 50 answers (ML factor analysis)."""
    df = flows.clean_survey(spark, sf_dir)
    out, _model = FT.factor_scores(df, ITEMS, 5)
    return round_doubles(out.select("row_id", *[f"factor_{j}" for j in range(1, 6)]), 4)


@register("f06_pca")
def f06_pca(spark, sf_dir):
    """Rows-only: principal-component scores of the five trait scores."""
    df = flows.clean_survey(spark, sf_dir)
    out, _model = FT.pca(df, SCORES, 5)
    return round_doubles(out.select("row_id", *[f"pc{j}" for j in range(1, 6)]), 4)
