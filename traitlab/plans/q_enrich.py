"""Queries for enrichment and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.plans.q_cluster import walsh_sql
from traitlab.sources.dims import SCORES


def _e01_sql():
    return O.with_clean(f"dim AS ({O.countries_values()})") + (
        "SELECT c.row_id, c.country, d.name, d.region, d.sub_region, d.intermediate_region FROM clean c LEFT JOIN dim d ON c.country = d.country"
    )


@register("e01_join_country", _e01_sql)
def e01_join_country(spark, sf_dir):
    return flows.enriched_survey(spark, sf_dir).select("row_id", "country", "name", "region", "sub_region", "intermediate_region")


E03_MIN = 60


def _e03_sql():
    return O.with_clean(
        f"dim AS ({O.countries_values()})",
        "cnt AS (SELECT country, count(*) AS n FROM clean GROUP BY country)",
    ) + (
        f"SELECT c.row_id, c.country, CASE WHEN cnt.n < {E03_MIN} THEN coalesce(d.region, c.country) ELSE c.country END AS folded "
        "FROM clean c JOIN cnt ON c.country = cnt.country LEFT JOIN dim d ON c.country = d.country"
    )


@register("e03_fold_rare", _e03_sql)
def e03_fold_rare(spark, sf_dir):
    from traitlab.operators.enrich import fold_rare

    df = flows.enriched_survey(spark, sf_dir)
    return fold_rare(df, "country", "region", min_count=E03_MIN, out="folded").select("row_id", "country", "folded")


def _e04_sql():
    return O.with_clean() + f"SELECT row_id, lat, lon, {O.us_region_sql('lat', 'lon')} AS us_region FROM clean"


@register("e04_us_region", _e04_sql)
def e04_us_region(spark, sf_dir):
    from traitlab.functions.columns import us_region

    return flows.clean_survey(spark, sf_dir).select("row_id", "lat", "lon", us_region("lat", "lon").alias("us_region"))


def _e05_sql():
    return O.with_clean(
        O.zs_cte(),
        O.nearest_first_k_ctes("zs", O.ZSCORES, 3, name="lab3"),
        O.nearest_first_k_ctes("zs", O.ZSCORES, 5, name="lab5"),
    ) + "SELECT lab3.row_id, lab3.cluster AS kmeans_3, lab5.cluster AS kmeans_5 FROM lab3 JOIN lab5 ON lab3.row_id = lab5.row_id"


@register("e05_glue_labels", _e05_sql)
def e05_glue_labels(spark, sf_dir):
    """Two labellings of the same rows glued on row_id."""
    from traitlab.operators.cluster.kmeans import assign_nearest, init_first_rows
    from traitlab.operators.enrich import glue_labels

    zs = flows.zscored_survey(spark, sf_dir)
    c3 = init_first_rows(zs, "row_id", flows.ZSCORES, 3)
    c5 = init_first_rows(zs, "row_id", flows.ZSCORES, 5)
    runs = [assign_nearest(zs, flows.ZSCORES, c).select("row_id", "cluster") for c in (c3, c5)]
    return glue_labels(runs, "row_id", ["kmeans_3", "kmeans_5"])


def _e06_sql():
    smp = O.first_rows_sql("clean", "500")
    return O.with_clean(f"dim AS ({O.countries_values()})", f"smp AS {smp}") + (
        "SELECT d.country, d.name, s.n, round(s.mean_o_score, 6) AS mean_o_score FROM dim d LEFT JOIN "
        "(SELECT country, count(*) AS n, avg(o_score) AS mean_o_score FROM smp GROUP BY country) s ON d.country = s.country"
    )


@register("e06_join_map", _e06_sql)
def e06_join_map(spark, sf_dir):
    from traitlab.operators.enrich import join_map
    from traitlab.operators.sample import sample_n
    from traitlab.sources.dims import country_fixture

    smp = sample_n(flows.clean_survey(spark, sf_dir), "row_id", 500)
    agg = smp.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.avg("o_score").alias("mean_o_score"))
    return round_doubles(join_map(country_fixture(spark).select("country", "name"), agg, "country"))


def _e07_sql():
    smp = O.first_rows_sql("clean", "200")
    return O.with_clean(O.zs_cte(), O.nearest_first_k_ctes("zs", O.ZSCORES, 5), f"smp AS {smp}") + (
        "SELECT s.row_id, s.o_score, lab.cluster FROM smp s JOIN lab ON s.row_id = lab.row_id"
    )


@register("e07_attach_labels", _e07_sql)
def e07_attach_labels(spark, sf_dir):
    from traitlab.operators.enrich import attach_labels
    from traitlab.operators.sample import sample_n

    smp = sample_n(flows.clean_survey(spark, sf_dir), "row_id", 200).select("row_id", "o_score")
    labels = flows.labelled_survey(spark, sf_dir).select("row_id", "cluster")
    return attach_labels(smp, labels, "row_id")


E08_EPS = 0.02


def _e08_sql():
    return (
        f"WITH p AS ({walsh_sql()}) SELECT a.vec_id AS i, b.vec_id AS j, round(sqrt((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2)), 6) AS dist "
        f"FROM p a JOIN p b ON (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) <= CAST({E08_EPS * E08_EPS!r} AS DOUBLE)"
    )


@register("e08_eps_pairs", _e08_sql)
def e08_eps_pairs(spark, sf_dir):
    from traitlab.operators.enrich import eps_pairs

    pts = flows.walsh_points(spark, sf_dir)
    return round_doubles(eps_pairs(pts, "vec_id", ["x1", "x2"], E08_EPS))


__all__ = ["SCORES"]


def _e02_sql():
    from traitlab.sources.dims import ITEMS, scoring_rows

    vals = ", ".join(f"('{i}', {O.q(q)})" for i, _p, _j, _r, q in scoring_rows())
    items = ", ".join(ITEMS)
    return O.with_clean(
        f"dim AS (SELECT * FROM (VALUES {vals}) AS t(id, question))",
        f"long AS (SELECT row_id, item, answer FROM (UNPIVOT (SELECT row_id, {items} FROM clean) ON {items} INTO NAME item VALUE answer))",
    ) + "SELECT l.row_id, l.item, l.answer, d.question FROM long l LEFT JOIN dim d ON l.item = d.id"


@register("e02_attach_question", _e02_sql)
def e02_attach_question(spark, sf_dir):
    """Question text by item id on the long form (broadcast of the 50-row
    item dimension)."""
    from traitlab.operators.enrich import attach_question
    from traitlab.operators.profile import to_long
    from traitlab.sources.dims import ITEMS, scoring_dim

    long = to_long(flows.clean_survey(spark, sf_dir).select("row_id", *ITEMS), ["row_id"], ITEMS, "item", "answer")
    return attach_question(long, scoring_dim(spark)).select("row_id", "item", "answer", "question")


def _p08_sql():
    from traitlab.sources.dims import ITEMS, scoring_rows

    mapping = {i: q for i, _p, _j, _r, q in scoring_rows()}
    cols = ", ".join(f'{c} AS "{c}: {mapping[c]}"' for c in ITEMS)
    return O.with_clean() + f"SELECT {cols}, {', '.join(SCORES)} FROM clean"


@register("p08_decorate", _p08_sql)
def p08_decorate(spark, sf_dir):
    """The first 55 headers become 'id: question' where mapped (scores keep their names)."""
    from traitlab.operators.clean import decorate
    from traitlab.sources.dims import ITEMS, scoring_rows

    mapping = {i: q for i, _p, _j, _r, q in scoring_rows()}
    df = flows.clean_survey(spark, sf_dir).select(*ITEMS, *SCORES)
    return decorate(df, mapping, 55)
