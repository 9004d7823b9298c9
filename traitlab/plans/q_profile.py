"""Queries for aggregation, profiles, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators import profile as A
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.sources.dims import ITEMS, SCORES

LAB = [O.zs_cte(), O.nearest_first_k_ctes("zs", O.ZSCORES, 5)]
REGION = [f"dim AS ({O.countries_values()})", "rl AS (SELECT c.*, d.region, d.sub_region, coalesce(d.region, 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country)"]


def _a02_sql():
    aggs = ", ".join(f"avg(c.{s}) AS mean_{s}, stddev_samp(c.{s}) AS std_{s}" for s in SCORES)
    unions = " UNION ALL ".join(
        f"SELECT cluster, '{st}' AS stat, '{s}' AS trait, {st}_{s} AS value FROM prof" for st in ("mean", "std") for s in SCORES
    )
    return O.with_clean(
        *LAB,
        f"prof AS (SELECT lab.cluster, {aggs} FROM clean c JOIN lab ON c.row_id = lab.row_id GROUP BY lab.cluster)",
        f"long AS ({unions})",
    ) + "SELECT stat, trait, " + ", ".join(f"round(max(CASE WHEN cluster = {c} THEN value END), 6) AS \"Cluster {c}\"" for c in range(5)) + " FROM long GROUP BY stat, trait"


@register("a02_profile_wide", _a02_sql)
def a02_profile_wide(spark, sf_dir):
    prof = A.cluster_profile(flows.labelled_survey(spark, sf_dir), SCORES)
    return round_doubles(A.profile_wide(prof, SCORES, ids=range(5)))


def _a03_sql():
    return O.with_clean(*LAB) + "SELECT DISTINCT cluster FROM lab"


@register("a03_distinct_clusters", _a03_sql)
def a03_distinct_clusters(spark, sf_dir):
    return A.distinct_sorted(flows.labelled_survey(spark, sf_dir), "cluster")


def _a05_sql():
    unions = " UNION ALL ".join(f"SELECT '{s}' AS trait, {s} AS value FROM clean" for s in SCORES)
    return O.with_clean(
        f"long AS ({unions})",
        "rng AS (SELECT trait, min(value) AS lo, max(value) AS hi FROM long GROUP BY trait)",
        "binned AS (SELECT l.trait, CAST(CASE WHEN r.hi - r.lo = 0 THEN 0 ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 30), 29) END AS INTEGER) AS bin, r.lo, r.hi FROM long l JOIN rng r ON l.trait = r.trait)",
    ) + (
        "SELECT trait, bin, round(lo + (hi - lo) * bin / 30, 6) AS bin_lo, round(lo + (hi - lo) * (bin + 1) / 30, 6) AS bin_hi, count(*) AS n "
        "FROM binned GROUP BY trait, bin, lo, hi"
    )


@register("a05_histogram", _a05_sql)
def a05_histogram(spark, sf_dir):
    return round_doubles(A.histogram(flows.clean_survey(spark, sf_dir), SCORES, 30))


def _a05l_sql():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    unions = " UNION ALL ".join(f"SELECT '{c}' AS trait, {c} AS value FROM lineitem WHERE {c} IS NOT NULL" for c in cols)
    return (
        f"WITH long AS ({unions}), rng AS (SELECT trait, min(value) AS lo, max(value) AS hi FROM long GROUP BY trait), "
        "binned AS (SELECT l.trait, CAST(CASE WHEN r.hi - r.lo = 0 THEN 0 ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 30), 29) END AS INTEGER) AS bin, r.lo, r.hi FROM long l JOIN rng r ON l.trait = r.trait) "
        "SELECT trait, bin, round(lo + (hi - lo) * bin / 30, 6) AS bin_lo, round(lo + (hi - lo) * (bin + 1) / 30, 6) AS bin_hi, count(*) AS n FROM binned GROUP BY trait, bin, lo, hi"
    )


@register("a05_histogram_lineitem", _a05l_sql)
def a05_histogram_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return round_doubles(A.histogram(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 30))


def _a06_sql():
    items = ", ".join(ITEMS)
    return O.with_clean(
        *LAB,
        f"long AS (SELECT cluster, item, answer FROM (UNPIVOT (SELECT lab.cluster, {items} FROM clean c JOIN lab ON c.row_id = lab.row_id) ON {items} INTO NAME item VALUE answer))",
        "cnt AS (SELECT item, CAST(answer AS INTEGER) AS answer, cluster, count(*) AS n FROM long WHERE answer IN (1, 2, 3, 4, 5) GROUP BY item, CAST(answer AS INTEGER), cluster)",
    ) + (
        "SELECT *, max(total) OVER () AS max_total FROM (SELECT item, answer, cluster, n, CAST(coalesce(sum(n) OVER (PARTITION BY item, answer ORDER BY cluster ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset, "
        "CAST(sum(n) OVER (PARTITION BY item, answer) AS BIGINT) AS total FROM cnt) t"
    )


@register("a06_answer_histogram", _a06_sql)
def a06_answer_histogram(spark, sf_dir):
    return A.answer_histogram(flows.labelled_survey(spark, sf_dir), ITEMS, "cluster")


def _a07_sql():
    rows = []
    for i, a in enumerate(SCORES):
        for j, b in enumerate(SCORES):
            v = "max(1.0E0)" if i == j else f"corr({SCORES[min(i, j)]}, {SCORES[max(i, j)]})"
            rows.append(f"SELECT '{a}' AS var1, '{b}' AS var2, round({v}, 2) AS corr FROM clean")
    return O.with_clean() + " UNION ALL ".join(rows)


@register("a07_correlations", _a07_sql)
def a07_correlations(spark, sf_dir):
    return A.correlations(flows.clean_survey(spark, sf_dir), SCORES, 2)


def _a07l_sql():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = "max(1.0E0)" if i == j else f"corr({cols[min(i, j)]}, {cols[max(i, j)]})"
            rows.append(f"SELECT '{a}' AS var1, '{b}' AS var2, round({v}, 4) AS corr FROM lineitem")
    return " UNION ALL ".join(rows)


@register("a07_correlations_lineitem", _a07l_sql)
def a07_correlations_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return A.correlations(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 4)


def _a08_sql():
    return O.with_clean() + (
        "SELECT country, n, CAST(rnk AS INTEGER) AS rank FROM (SELECT country, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rnk FROM clean GROUP BY country) t WHERE rnk <= 20"
    )


@register("a08_top_countries", _a08_sql)
def a08_top_countries(spark, sf_dir):
    return A.top_with_ties(flows.clean_survey(spark, sf_dir), "country", 20)


def _a09_sql():
    means = ", ".join(f"round(avg({s}), 6) AS mean_{s}" for s in SCORES)
    return O.with_clean(*REGION) + f"SELECT sub_region, count(*) AS n, {means} FROM rl GROUP BY sub_region"


@register("a09_group_means", _a09_sql)
def a09_group_means(spark, sf_dir):
    return round_doubles(A.group_means(flows.enriched_survey(spark, sf_dir), ["sub_region"], SCORES))


def _a10_sql():
    cols = ", ".join(SCORES)
    return O.with_clean() + f"SELECT row_id, variable, value FROM (UNPIVOT (SELECT row_id, {cols} FROM clean) ON {cols} INTO NAME variable VALUE value)"


@register("a10_to_long", _a10_sql)
def a10_to_long(spark, sf_dir):
    return A.to_long(flows.clean_survey(spark, sf_dir).select("row_id", *SCORES), ["row_id"], SCORES)


def _a11_sql():
    means = ", ".join(f"avg({s}) AS {s}" for s in SCORES)
    cols = ", ".join(SCORES)
    return O.with_clean(
        *REGION,
        f"gm AS (SELECT sub_region, {means} FROM rl WHERE sub_region IS NOT NULL GROUP BY sub_region)",
        f"long AS (SELECT sub_region, trait, score FROM (UNPIVOT gm ON {cols} INTO NAME trait VALUE score))",
    ) + (
        "SELECT sub_region, trait, round(score, 6) AS score, CAST(pos AS INTEGER) AS pos FROM "
        "(SELECT *, row_number() OVER (PARTITION BY trait ORDER BY score DESC, sub_region) AS pos FROM long) t WHERE pos <= 5"
    )


@register("a11_top_groups", _a11_sql)
def a11_top_groups(spark, sf_dir):
    df = flows.enriched_survey(spark, sf_dir).filter(F.col("sub_region").isNotNull())
    gm = df.groupBy("sub_region").agg(*[F.avg(s).alias(s) for s in SCORES])
    long = A.to_long(gm, ["sub_region"], SCORES, "trait", "score")
    return round_doubles(A.top_groups(long, "sub_region", "trait", "score", 5))


def _a13_sql():
    unions = " UNION ALL ".join(f"SELECT '{s}' AS feature, region_label AS y, {s} AS x FROM rl" for s in SCORES)
    return O.with_clean(
        *REGION,
        f"long AS ({unions})",
        "g AS (SELECT feature, y, count(*) AS ng, avg(x) AS mg FROM long GROUP BY feature, y)",
        "t AS (SELECT feature, avg(x) AS mt FROM long GROUP BY feature)",
        "sst AS (SELECT l.feature, sum((l.x - t.mt) * (l.x - t.mt)) AS sst FROM long l JOIN t ON l.feature = t.feature GROUP BY l.feature)",
        "ssb AS (SELECT g.feature, sum(g.ng * (g.mg - t.mt) * (g.mg - t.mt)) AS ssb FROM g JOIN t ON g.feature = t.feature GROUP BY g.feature)",
    ) + "SELECT ssb.feature, round(ssb / sst, 6) AS eta_sq FROM ssb JOIN sst ON ssb.feature = sst.feature"


@register("a13_correlation_ratio", _a13_sql)
def a13_correlation_ratio(spark, sf_dir):
    return round_doubles(A.correlation_ratio(flows.region_labelled(spark, sf_dir), SCORES, "region_label"))


def _a18_sql():
    qs = ", ".join(f"quantile_cont(o_score, {p}) AS {n}" for p, n in [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")])
    return O.with_clean(*REGION) + f"SELECT region_label, {qs} FROM rl GROUP BY region_label"


@register("a18_five_numbers", _a18_sql)
def a18_five_numbers(spark, sf_dir):
    return round_doubles(A.five_numbers(flows.region_labelled(spark, sf_dir), ["region_label"], "o_score"))


def _a19_sql():
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in ITEMS)
    return O.with_clean() + (
        f"SELECT count(*) AS n_before, count(*) FILTER (WHERE IPC = 1 AND {notnull}) AS n_kept, "
        f"count(*) - count(*) FILTER (WHERE IPC = 1 AND {notnull}) AS n_dropped, "
        f"round(count(*) FILTER (WHERE IPC = 1 AND {notnull}) * 100.0E0 / count(*), 6) AS kept_pct FROM num"
    )


@register("a19_kept_share", _a19_sql)
def a19_kept_share(spark, sf_dir):
    num = flows.numeric_survey(spark, sf_dir)
    keep = (F.col("IPC") == 1) & F.forall(F.array(*[F.col(c) for c in ITEMS]), lambda x: x.isNotNull())
    return round_doubles(A.kept_share(num, keep))


def _a20_sql():
    items = ", ".join(f"c.{i}" for i in ITEMS)
    smp = O.first_rows_sql("clean", "1000")
    return O.with_clean(*LAB, f"smp AS {smp}") + f"SELECT c.row_id, {items}, CAST(lab.cluster AS DOUBLE) AS cluster FROM smp c JOIN lab ON c.row_id = lab.row_id"


@register("a20_dashboard_extract", _a20_sql)
def a20_dashboard_extract(spark, sf_dir):
    """Dashboard extract: 50 answers + cluster for a fixed-size sample of
    1000 rows (the sample size is the feature); cluster coerced to number."""
    from traitlab.operators.sample import sample_n

    lab = flows.labelled_survey(spark, sf_dir)
    smp = sample_n(lab, "row_id", 1000)
    return smp.select("row_id", *ITEMS, F.col("cluster").cast("double").alias("cluster"))
