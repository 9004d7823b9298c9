"""Queries over the survey view: sources, cleaning, scoring, the minimum slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.functions.columns import guarded_number
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.sources.dims import ITEMS, SCORES
from traitlab.sources.survey import RAW_COLUMNS

SCORE_COLS = ", ".join(SCORES)


# ---------------------------------------------------------------- S1 / P1-P5


def _s01_sql():
    return O.with_clean() + "SELECT * FROM parsed"


@register("s01_tab_split", _s01_sql)
def s01_tab_split(spark, sf_dir):
    return flows.parsed_survey(spark, sf_dir)


def _p01_sql():
    return O.with_clean() + "SELECT * FROM num"


@register("p01_to_number", _p01_sql)
def p01_to_number(spark, sf_dir):
    return flows.numeric_survey(spark, sf_dir)


def _p02_sql():
    return O.with_clean() + "SELECT row_id, IPC, country FROM num WHERE IPC = 1"


@register("p02_keep_ipc", _p02_sql)
def p02_keep_ipc(spark, sf_dir):
    from traitlab.operators.clean import keep_equal

    return keep_equal(flows.numeric_survey(spark, sf_dir), "IPC", 1).select("row_id", "IPC", "country")


def _p03_sql():
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in ITEMS)
    return O.with_clean() + f"SELECT row_id FROM num WHERE {notnull}"


@register("p03_drop_null_rows", _p03_sql)
def p03_drop_null_rows(spark, sf_dir):
    from traitlab.operators.clean import drop_null_rows

    return drop_null_rows(flows.numeric_survey(spark, sf_dir), ITEMS).select("row_id")


def _p05_sql():
    return O.with_clean() + f"SELECT row_id, country, {SCORE_COLS} FROM clean"


@register("p05_trait_scores", _p05_sql)
def p05_trait_scores(spark, sf_dir):
    return flows.clean_survey(spark, sf_dir).select("row_id", "country", *SCORES)


# ---------------------------------------------------------------- minimum slice


def _a01_sql():
    k = 5
    ctes = [O.zs_cte(), O.nearest_first_k_ctes("zs", O.ZSCORES, k)]
    aggs = ", ".join(f"avg(c.{s}) AS mean_{s}, stddev_samp(c.{s}) AS std_{s}" for s in SCORES)
    outs = ", ".join(f"{O.rnd('mean_' + s)} AS mean_{s}, {O.rnd('std_' + s)} AS std_{s}" for s in SCORES)
    return (
        O.with_clean(*ctes)
        + f"SELECT CAST(cluster AS INTEGER) AS cluster, n, {O.rnd('n * 100.0E0 / sum(n) OVER ()')} AS pct, {outs} FROM ("
        + f"SELECT lab.cluster, count(*) AS n, {aggs} FROM clean c JOIN lab ON c.row_id = lab.row_id GROUP BY lab.cluster) t"
    )


@register("a01_cluster_profile", _a01_sql)
def a01_cluster_profile(spark, sf_dir):
    return round_doubles(flows.traits_by_cluster(spark, sf_dir, k=5))


# ---------------------------------------------------------------- P4, P6-P20


def _p04_sql():
    return O.with_clean() + "SELECT row_id, " + ", ".join(f"EXT{j}" for j in range(1, 11)) + " FROM clean"


@register("p04_pick", _p04_sql)
def p04_pick(spark, sf_dir):
    from traitlab.operators.clean import pick

    df = flows.clean_survey(spark, sf_dir)
    return df.select(*pick(df, prefixes=["EXT"], max_len=5, first=50, keep=["row_id"]))


def _p06_sql():
    from traitlab.sources.dims import scoring_rows

    vals = ", ".join(f"('{i}', '{p}', {'TRUE' if r else 'FALSE'})" for i, p, _j, r, _q in scoring_rows(True))
    items = ", ".join(ITEMS)
    return O.with_clean(
        f"dim AS (SELECT * FROM (VALUES {vals}) AS t(id, prefix, rev))",
        f"long AS (SELECT row_id, item, answer FROM (UNPIVOT (SELECT row_id, {items} FROM clean) ON {items} INTO NAME item VALUE answer))",
        "keyed AS (SELECT l.row_id, d.prefix, CASE WHEN d.rev THEN 6 - l.answer ELSE l.answer END AS v FROM long l JOIN dim d ON l.item = d.id)",
    ) + (
        "SELECT row_id, "
        + ", ".join(f"sum(CASE WHEN prefix = '{p}' THEN v ELSE 0.0 END) AS {s}" for p, s in [("OPN", "o_score"), ("CSN", "c_score"), ("EXT", "e_score"), ("AGR", "a_score"), ("EST", "n_score")])
        + " FROM keyed GROUP BY row_id"
    )


@register("p06_reverse_scores", _p06_sql)
def p06_reverse_scores(spark, sf_dir):
    """Quiz keying: reverse items count 6 - v.  Wide form (one projection),
    checked against a long-form SQL (unpivot + join + group)."""
    from traitlab.operators.clean import trait_scores
    from traitlab.sources.dims import scoring_rows

    clean = flows.clean_survey(spark, sf_dir).drop(*SCORES)
    return trait_scores(clean, scoring_rows(use_quiz_keys=True)).select("row_id", *SCORES)


def _p07_sql():
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ITEMS)
    return O.with_clean() + f"SELECT row_id, CAST({n} AS INTEGER) AS n_answered, ({n}) = 50 AS complete FROM num"


@register("p07_complete", _p07_sql)
def p07_complete(spark, sf_dir):
    from traitlab.operators.clean import complete

    return complete(flows.numeric_survey(spark, sf_dir), ITEMS).select("row_id", "n_answered", "complete")


REF_SCORE_NAMES = {"o_score": "O score", "c_score": "C score", "e_score": "E score", "a_score": "A score", "n_score": "N score"}


def _p09_sql():
    return O.with_clean() + "SELECT row_id, " + ", ".join(f'{s} AS "{n}"' for s, n in REF_SCORE_NAMES.items()) + " FROM clean"


@register("p09_rename", _p09_sql)
def p09_rename(spark, sf_dir):
    from traitlab.operators.clean import rename

    return rename(flows.clean_survey(spark, sf_dir).select("row_id", *SCORES), REF_SCORE_NAMES)


def _p10_sql():
    return O.with_clean() + "SELECT * EXCLUDE (lat, lon, IPC) FROM clean"


@register("p10_drop", _p10_sql)
def p10_drop(spark, sf_dir):
    from traitlab.operators.clean import drop

    return drop(flows.clean_survey(spark, sf_dir), ["lat", "lon", "IPC"])


def _p11_sql():
    return O.with_clean() + "SELECT row_id, upper(country) AS country FROM clean WHERE lower(country) NOT IN ('us', 'gb', 'xx')"


@register("p11_keep_in", _p11_sql)
def p11_keep_in(spark, sf_dir):
    from traitlab.operators.clean import keep_in

    df = keep_in(flows.clean_survey(spark, sf_dir), "country", ["US", "gb", "Xx"], negate=True, casefold=True)
    return df.select("row_id", F.upper("country").alias("country"))


def _p12_sql():
    return O.with_clean() + "SELECT row_id, EXT1 FROM num WHERE EXT1 IS NOT NULL AND NOT isnan(EXT1)"


@register("p12_keep_notnull", _p12_sql)
def p12_keep_notnull(spark, sf_dir):
    from traitlab.operators.clean import keep_notnull

    return keep_notnull(flows.numeric_survey(spark, sf_dir).select("row_id", "EXT1"), ["EXT1"])


def _p13_sql():
    return O.with_clean() + "SELECT row_id, v AS value FROM (SELECT row_id, " + O.guard_sql("EST3") + " AS v FROM parsed) t WHERE v IS NOT NULL AND NOT isnan(v) AND v BETWEEN 1 AND 5"


@register("p13_text_number", _p13_sql)
def p13_text_number(spark, sf_dir):
    v = guarded_number("EST3")
    df = flows.parsed_survey(spark, sf_dir).select("row_id", v.alias("value"))
    return df.filter(F.col("value").isNotNull() & ~F.isnan("value") & F.col("value").between(1, 5))


def _p15_sql():
    return O.with_clean(f"dim AS ({O.countries_values()})") + "SELECT c.row_id, coalesce(CAST(d.region AS VARCHAR), 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country"


@register("p15_text_label", _p15_sql)
def p15_text_label(spark, sf_dir):
    return flows.region_labelled(spark, sf_dir).select("row_id", "region_label")


def _p16_sql(desc=False):
    return O.with_clean() + f"SELECT row_id, o_score FROM clean ORDER BY row_id {'DESC' if desc else ''} LIMIT 10"


@register("p16_head", _p16_sql)
def p16_head(spark, sf_dir):
    from traitlab.operators.clean import head

    return head(flows.clean_survey(spark, sf_dir).select("row_id", "o_score"), "row_id", 10)


@register("p16_tail", lambda: _p16_sql(True))
def p16_tail(spark, sf_dir):
    from traitlab.operators.clean import tail

    return tail(flows.clean_survey(spark, sf_dir).select("row_id", "o_score"), "row_id", 10)


def _p18_sql():
    from traitlab.sources.dims import CLUSTER_DEFAULT, CLUSTER_NAMES

    whens = " ".join(f"WHEN {k} THEN {O.q(v[0])}" for k, v in CLUSTER_NAMES.items())
    return O.with_clean(O.zs_cte(), O.nearest_first_k_ctes("zs", O.ZSCORES, 5)) + (
        f"SELECT row_id, cluster, cluster + 1 AS display_cluster, CASE cluster {whens} ELSE {O.q(CLUSTER_DEFAULT[0])} END AS title FROM lab"
    )


@register("p18_cluster_names", _p18_sql)
def p18_cluster_names(spark, sf_dir):
    from traitlab.operators.clean import relabel
    from traitlab.sources.dims import CLUSTER_DEFAULT, CLUSTER_NAMES

    lab = flows.labelled_survey(spark, sf_dir).select("row_id", "cluster")
    lab = relabel(lab, "cluster", {k: v[0] for k, v in CLUSTER_NAMES.items()}, CLUSTER_DEFAULT[0], out="title")
    return lab.select("row_id", "cluster", (F.col("cluster") + 1).alias("display_cluster"), "title")


def _p19_sql():
    from traitlab.sources.dims import TRAIT_DESCRIPTION_DEFAULT, TRAIT_DESCRIPTIONS

    whens = " ".join(f"WHEN '{k}' THEN {O.q(v)}" for k, v in TRAIT_DESCRIPTIONS.items())
    items = ", ".join(ITEMS)
    return O.with_clean(f"long AS (SELECT item FROM (UNPIVOT (SELECT {items} FROM clean) ON {items} INTO NAME item VALUE answer))") + (
        f"SELECT DISTINCT item, CASE substring(item, 1, 3) {whens} ELSE {O.q(TRAIT_DESCRIPTION_DEFAULT)} END AS description FROM long"
    )


@register("p19_trait_description", _p19_sql)
def p19_trait_description(spark, sf_dir):
    from traitlab.operators.clean import relabel
    from traitlab.operators.profile import to_long
    from traitlab.sources.dims import TRAIT_DESCRIPTION_DEFAULT, TRAIT_DESCRIPTIONS

    long = to_long(flows.clean_survey(spark, sf_dir), [], ITEMS, "item", "answer").select("item").distinct()
    long = long.withColumn("prefix", F.substring("item", 1, 3))
    return relabel(long, "prefix", TRAIT_DESCRIPTIONS, TRAIT_DESCRIPTION_DEFAULT, out="description").select("item", "description")


def _p20_sql():
    return "SELECT user_id, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0) AS BIGINT) AS elapsed_s FROM events GROUP BY user_id"


@register("p20_elapsed_seconds", _p20_sql)
def p20_elapsed_seconds(spark, sf_dir):
    from traitlab.functions.columns import elapsed_seconds

    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    g = ev.groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return g.select("user_id", elapsed_seconds("t0", "t1").alias("elapsed_s"))
