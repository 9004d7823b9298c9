"""Grid-result analyses (A4, A12, A14-A17, P14, P17) over a K-Means grid whose
fits SQL can reproduce, so every analysis has an oracle.  The grid runs on
the embeddings: two signed sums of all values, or all 64 values, raw and standardised,
0 or 1 Lloyd updates from the first k rows by det, k in {3, 4}."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators import profile as A
from traitlab.operators import search as M
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.plans.q_cluster import XS, walsh_sql

FEATURES = {"sums2": ["w1", "w2"], "all64": XS}
KS = (3, 4)
STEPS = (0, 1)
SCALED = (False, True)
MODELS = [f"KMeans{s}" for s in STEPS]
METRICS = ["calinski_harabasz", "davies_bouldin", "silhouette"]

_GRID: dict = {}


def grid(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GRID:
        p = flows.walsh_points(spark, sf_dir, 2, "w", keep=True)
        _GRID[key] = M.assignment_grid(p, "vec_id", FEATURES, KS, STEPS, SCALED).cache()
    return _GRID[key]


def _sq(a, b, cols):
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


def _config_ctes(i: int, data_type: str, cols: list[str], scaled: bool, steps: int, k: int) -> list[str]:
    g = f"g{i}"
    D = O.det_sql("vec_id")
    clist = ", ".join(cols)
    if scaled:
        stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
        zs = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}" for c in cols)
        ctes = [f"{g}_st AS (SELECT {stats} FROM pts0)", f"{g}_p AS (SELECT vec_id, {zs} FROM pts0 JOIN {g}_st ON TRUE)"]
    else:
        ctes = [f"{g}_p AS (SELECT vec_id, {clist} FROM pts0)"]
    ctes.append(f"{g}_c0 AS (SELECT row_number() OVER (ORDER BY {D}, vec_id) - 1 AS cid, {clist} FROM {g}_p ORDER BY {D}, vec_id LIMIT {k})")

    def assign(c, name):
        return (
            f"{name} AS (SELECT vec_id, CAST(cid AS INTEGER) AS cluster FROM (SELECT p.vec_id, c.cid, row_number() OVER (PARTITION BY p.vec_id ORDER BY {_sq('p', 'c', cols)}, c.cid) AS rn "
            f"FROM {g}_p p JOIN {c} c ON TRUE) t WHERE rn = 1)"
        )

    cur = f"{g}_c0"
    for s in range(1, steps + 1):
        ctes.append(assign(cur, f"{g}_a{s}"))
        ctes.append(f"{g}_m{s} AS (SELECT a.cluster AS cid, " + ", ".join(f"avg(p.{c}) AS {c}" for c in cols) + f" FROM {g}_a{s} a JOIN {g}_p p ON a.vec_id = p.vec_id GROUP BY a.cluster)")
        ctes.append(f"{g}_c{s} AS (SELECT c.cid, " + ", ".join(f"coalesce(m.{c}, c.{c}) AS {c}" for c in cols) + f" FROM {cur} c LEFT JOIN {g}_m{s} m ON c.cid = m.cid)")
        cur = f"{g}_c{s}"
    ctes.append(assign(cur, f"{g}_lab"))
    ctes.append(f"{g}_j AS (SELECT p.*, l.cluster FROM {g}_p p JOIN {g}_lab l ON p.vec_id = l.vec_id)")
    means = ", ".join(f"avg({c}) AS {c}" for c in cols)
    ctes.append(f"{g}_cm AS (SELECT cluster, count(*) AS n, {means} FROM {g}_j GROUP BY cluster)")
    ctes.append(f"{g}_gm AS (SELECT {means}, count(*) AS n FROM {g}_j)")
    ctes.append(
        f"{g}_ch AS (SELECT (SELECT count(*) FROM {g}_cm) AS k, (SELECT n FROM {g}_gm) AS n, "
        f"(SELECT sum(cm.n * ({_sq('cm', 'gm', cols)})) FROM {g}_cm cm JOIN {g}_gm gm ON TRUE) AS b, "
        f"(SELECT sum({_sq('j', 'cm', cols)}) FROM {g}_j j JOIN {g}_cm cm ON j.cluster = cm.cluster) AS w)"
    )
    ctes.append(f"{g}_sc AS (SELECT cm.*, (SELECT avg(sqrt({_sq('j', 'cm', cols)})) FROM {g}_j j WHERE j.cluster = cm.cluster) AS s FROM {g}_cm cm)")
    ctes.append(
        f"{g}_db AS (SELECT avg(coalesce(r, 0.0)) AS db FROM (SELECT a.cluster, max(CASE WHEN sqrt({_sq('a', 'b', cols)}) > 0 THEN (a.s + b.s) / sqrt({_sq('a', 'b', cols)}) END) AS r "
        f"FROM {g}_sc a JOIN {g}_sc b ON a.cluster <> b.cluster GROUP BY a.cluster) t)"
    )
    ctes.append(
        f"{g}_sil AS (SELECT avg(CASE WHEN ab.a IS NULL THEN 0.0 ELSE (ab.b - ab.a) / greatest(ab.a, ab.b) END) AS sil FROM {g}_j p LEFT JOIN "
        f"(SELECT i, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b FROM "
        f"(SELECT a.vec_id AS i, a.cluster AS li, b.cluster AS lj, avg({_sq('a', 'b', cols)}) AS md FROM {g}_j a JOIN {g}_j b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.cluster, b.cluster) m GROUP BY i) ab ON p.vec_id = ab.i)"
    )
    ctes.append(f"{g}_en AS (SELECT -sum((n * 1.0E0 / t) * ln(n * 1.0E0 / t)) AS ent FROM {g}_cm JOIN (SELECT sum(n) AS t FROM {g}_cm) tt ON TRUE)")
    model = f"KMeans{steps}"
    cid = f"{model}|{data_type}|{str(scaled).lower()}|{k}"
    ctes.append(
        f"{g}_row AS (SELECT '{cid}' AS config_id, '{model}' AS model, '{data_type}' AS data_type, {str(scaled).upper()} AS scaled, {k} AS n_clusters, "
        f"CASE WHEN ch.k < 2 THEN -1.0 WHEN ch.w <= 0 THEN 0.0 ELSE (ch.b / (ch.k - 1)) / (ch.w / (ch.n - ch.k)) END AS calinski_harabasz, "
        f"CASE WHEN ch.k < 2 THEN 'Infinity'::DOUBLE ELSE db.db END AS davies_bouldin, CASE WHEN ch.k < 2 THEN -1.0 ELSE sil.sil END AS silhouette, "
        f"CAST(ch.k AS BIGINT) AS n_clusters_found, en.ent AS cluster_entropy FROM {g}_ch ch JOIN {g}_db db ON TRUE JOIN {g}_sil sil ON TRUE JOIN {g}_en en ON TRUE)"
    )
    return ctes


def grid_ctes() -> list[str]:
    ctes = [f"pts0 AS ({walsh_sql(2, 'w', keep=True)})"]
    rows = []
    i = 0
    for data_type, cols in FEATURES.items():
        for sc in SCALED:
            for steps in STEPS:
                for k in KS:
                    ctes += _config_ctes(i, data_type, cols, sc, steps, k)
                    rows.append(f"SELECT * FROM g{i}_row")
                    i += 1
    ctes.append("grid AS (" + " UNION ALL ".join(rows) + ")")
    return ctes


def with_grid(*extra: str) -> str:
    return "WITH " + ",\n".join(grid_ctes() + list(extra)) + "\n"


def _mean_cols(prefix: str = "") -> str:
    return ", ".join(f"round(avg({m}), 6) AS {m}" for m in METRICS)


@register("m01_assignment_grid", lambda: with_grid() + "SELECT config_id, model, data_type, scaled, n_clusters, " + ", ".join(f"round({m}, 6) AS {m}" for m in METRICS + ["cluster_entropy"]) + ", n_clusters_found FROM grid")
def m01_assignment_grid(spark, sf_dir):
    """M1 with SQL-reproducible fits: one metrics row per configuration."""
    return round_doubles(grid(spark, sf_dir))


@register("a04_pivot_mean", lambda: with_grid() + "SELECT n_clusters_found, " + ", ".join(f"round(avg(silhouette) FILTER (WHERE model = '{m}'), 6) AS {m}" for m in MODELS) + " FROM grid GROUP BY n_clusters_found")
def a04_pivot_mean(spark, sf_dir):
    return round_doubles(A.pivot_mean(grid(spark, sf_dir), "n_clusters_found", "model", "silhouette", MODELS))


@register("a12_mean_by_model", lambda: with_grid() + f"SELECT model, scaled, {_mean_cols()} FROM grid GROUP BY model, scaled")
def a12_mean_by_model(spark, sf_dir):
    return round_doubles(A.metric_means(grid(spark, sf_dir), ["model", "scaled"], METRICS))


def _a14_sql():
    return with_grid(
        "rg AS (SELECT min(silhouette) AS s0, max(silhouette) AS s1, min(cluster_entropy) AS e0, max(cluster_entropy) AS e1 FROM grid)",
        "cp AS (SELECT g.*, (silhouette - s0) / (s1 - s0) + (cluster_entropy - e0) / (e1 - e0) AS composite FROM grid g JOIN rg ON TRUE)",
    ) + "SELECT model, config_id, round(composite, 6) AS composite FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY composite DESC, config_id) AS r FROM cp) t WHERE r = 1"


@register("a14_best_per_model", _a14_sql)
def a14_best_per_model(spark, sf_dir):
    return round_doubles(A.best_config(grid(spark, sf_dir)).select("model", "config_id", "composite"))


@register("a15_max_silhouette", lambda: with_grid() + "SELECT round(max(silhouette), 6) AS max_silhouette FROM grid")
def a15_max_silhouette(spark, sf_dir):
    return round_doubles(A.global_max(grid(spark, sf_dir), "silhouette"))


def _cmp_ctes():
    unions = " UNION ALL ".join(f"SELECT scaled, model, '{m}' AS metric, {m} AS value FROM mm" for m in METRICS)
    return [
        f"mm AS (SELECT scaled, model, {', '.join(f'avg({m}) AS {m}' for m in METRICS)} FROM grid GROUP BY scaled, model)",
        f"lg AS ({unions})",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY scaled, metric ORDER BY value DESC, model) AS r FROM lg)",
        "cmp AS (SELECT o.scaled, o.metric, b.model AS best_model, o.model AS other_model, round_even(abs(b.value - o.value) / ((b.value + o.value) / 2) * 100, 1) AS pct_diff "
        "FROM rk o JOIN rk b ON o.scaled = b.scaled AND o.metric = b.metric AND b.r = 1 WHERE o.r > 1)",
    ]


@register("a16_compare_best", lambda: with_grid(*_cmp_ctes()) + "SELECT * FROM cmp")
def a16_compare_best(spark, sf_dir):
    return A.compare_best(grid(spark, sf_dir), METRICS, by="scaled")


def _a17_sql():
    return with_grid(*_cmp_ctes()) + (
        "SELECT metric, scaled, printf('For %s (%s = %s), %s is best, ahead of %s.', metric, 'scaled', CAST(scaled AS VARCHAR), best_model, others) AS sentence FROM "
        "(SELECT metric, scaled, best_model, string_agg(printf('%s (%.1f%%)', other_model, pct_diff), ' and ' ORDER BY printf('%s (%.1f%%)', other_model, pct_diff)) AS others "
        "FROM cmp GROUP BY metric, scaled, best_model) t"
    )


@register("a17_summary_sentences", _a17_sql)
def a17_summary_sentences(spark, sf_dir):
    return A.summary_sentences(A.compare_best(grid(spark, sf_dir), METRICS, by="scaled"), by="scaled")


NAMES = {"calinski_harabasz": "Calinski-Harabasz", "davies_bouldin": "Davies-Bouldin", "silhouette": "Silhouette"}


def _p14_sql():
    unions = " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM mm" for m in METRICS)
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items())
    return with_grid(f"mm AS (SELECT model, {', '.join(f'avg({m}) AS {m}' for m in METRICS)} FROM grid GROUP BY model)", f"lg AS ({unions})") + (
        f"SELECT model, metric, round(value, 6) AS value, CASE metric {whens} ELSE 'Other' END AS metric_name FROM lg"
    )


@register("p14_relabel_metrics", _p14_sql)
def p14_relabel_metrics(spark, sf_dir):
    """Means by model in long form; the '_Mean' suffix removed, display names mapped."""
    from traitlab.operators.clean import relabel

    mm = A.metric_means(grid(spark, sf_dir), ["model"], METRICS).withColumnsRenamed({m: f"{m}_Mean" for m in METRICS})
    long = A.to_long(mm, ["model"], [f"{m}_Mean" for m in METRICS], "metric", "value")
    long = long.withColumn("metric", F.regexp_replace("metric", "_Mean$", ""))
    return round_doubles(relabel(long, "metric", NAMES, "Other", out="metric_name"))


@register("p17_db_ch_ratio", lambda: with_grid() + "SELECT config_id, round(CASE WHEN calinski_harabasz = 0 THEN NULL ELSE davies_bouldin / calinski_harabasz END, 9) AS db_ch_ratio FROM grid")
def p17_db_ch_ratio(spark, sf_dir):
    from traitlab.operators.clean import ratio

    return round_doubles(ratio(grid(spark, sf_dir), "davies_bouldin", "calinski_harabasz", "db_ch_ratio").select("config_id", "db_ch_ratio"), 9)


def _a18_sql():
    qs = ", ".join(f"round(quantile_cont(silhouette, {p}), 6) AS {n}" for p, n in [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")])
    return with_grid() + f"SELECT model, scaled, {qs} FROM grid GROUP BY model, scaled"


@register("a18_five_numbers_grid", _a18_sql)
def a18_five_numbers_grid(spark, sf_dir):
    """Box-plot numbers of the silhouette by model x switch."""
    return round_doubles(A.five_numbers(grid(spark, sf_dir), ["model", "scaled"], "silhouette"))


def _u01_sql():
    return with_grid() + (
        "SELECT model, config_id, round(silhouette, 6) AS silhouette, NULL::BIGINT AS n_clusters_found FROM grid WHERE model = 'KMeans0' "
        "UNION ALL SELECT model, config_id, NULL::DOUBLE, n_clusters_found FROM grid WHERE model = 'KMeans1'"
    )


@register("u01_union_results", _u01_sql)
def u01_union_results(spark, sf_dir):
    """Results of two runs with different columns, unioned by name."""
    g = grid(spark, sf_dir)
    a = g.filter(F.col("model") == "KMeans0").select("model", "config_id", "silhouette")
    b = g.filter(F.col("model") == "KMeans1").select("model", "config_id", "n_clusters_found")
    return round_doubles(a.unionByName(b, allowMissingColumns=True))
