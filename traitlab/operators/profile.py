"""Aggregation, profile, window and reshape operators.

Wide inputs are unpivoted *before* grouping so partial aggregation runs on
every partition and only the (small) group counts are shuffled.  Windows
that have no partition key only ever run over aggregated tables (one row
per cluster / country / group), never over raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitlab.operators.ordered import running_sums
from traitlab.operators.sample import MAX_GROUPS, collect_bounded, null_safe_join


def cluster_profile(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> DataFrame:
    """A1: per cluster n, share of all rows (%), mean and sample std of each column."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    prof = df.groupBy(label).agg(*aggs)
    total = F.sum("n").over(Window.partitionBy())
    return prof.withColumn("pct", F.col("n") * F.lit(100.0) / total)


def profile_long(profile: DataFrame, cols: Sequence[str], label: str = "cluster") -> DataFrame:
    """A2 step 1: (cluster, stat, trait, value) from an A1 profile."""
    ids = [label]
    values = [f"mean_{c}" for c in cols] + [f"std_{c}" for c in cols]
    long = profile.unpivot(ids, values, "stat_trait", "value")
    return long.select(
        label,
        F.split("stat_trait", "_", 2).getItem(0).alias("stat"),
        F.split("stat_trait", "_", 2).getItem(1).alias("trait"),
        "value",
    )


def profile_wide(profile: DataFrame, cols: Sequence[str], label: str = "cluster", ids: Sequence | None = None) -> DataFrame:
    """A2: rows (stat, trait), one column ``Cluster c`` per cluster id.

    Pivot values are the cluster ids, listed explicitly: ``ids``, or those
    found (bounded)."""
    ids = list(ids) if ids is not None else sorted(r[0] for r in collect_bounded(profile.select(label).distinct(), MAX_GROUPS, "profile_wide"))
    long = profile_long(profile, cols, label)
    wide = long.groupBy("stat", "trait").pivot(label, ids).agg(F.first("value"))
    return wide.select("stat", "trait", *[F.col(f"`{i}`").alias(f"Cluster {i}") for i in ids])


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """A3."""
    return df.select(col).distinct().orderBy(col)


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: Sequence | None = None) -> DataFrame:
    """A4: mean of ``value`` by ``row`` x ``col``."""
    return df.groupBy(row).pivot(col, list(values) if values is not None else None).agg(F.avg(value))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """A5: equi-width histogram per column over [min, max]; the last bin is closed.

    One wide aggregate finds the ranges (two numbers per column), then one
    pass turns each row into its bin numbers, which are unpivoted and counted:
    the shuffle carries counts only."""
    cols = list(cols)
    r = df.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(cols) for f in (F.min, F.max)]).first()
    ranges = {c: (float(r[f"min{i}"]), float(r[f"max{i}"])) for i, c in enumerate(cols) if r[f"min{i}"] is not None}
    spark = df.sparkSession
    if not ranges:
        return spark.createDataFrame([], "trait string, bin int, bin_lo double, bin_hi double, n bigint")

    def bin_of(c):
        lo, hi = ranges[c]
        if lo == hi:
            return F.when(F.col(c).isNotNull(), F.lit(0))
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")

    long = df.select(*[bin_of(c).alias(c) for c in ranges]).unpivot([], list(ranges), "trait", "bin").filter(F.col("bin").isNotNull())
    counts = long.groupBy("trait", "bin").agg(F.count(F.lit(1)).alias("n"))
    table = spark.createDataFrame([(c, lo, hi) for c, (lo, hi) in ranges.items()], "trait string, lo double, hi double")
    out = counts.join(F.broadcast(table), "trait")
    w = F.col("hi") - F.col("lo")
    return out.select(
        "trait",
        "bin",
        (F.col("lo") + w * F.col("bin") / F.lit(bins)).alias("bin_lo"),
        (F.col("lo") + w * (F.col("bin") + 1) / F.lit(bins)).alias("bin_hi"),
        "n",
    )


def answer_histogram(df: DataFrame, items: Sequence[str], label: str = "cluster", lo: int = 1, hi: int = 5) -> DataFrame:
    """Count per (item, answer, cluster) for answers lo..hi, with the
    stacked offset (sum of earlier clusters) and each bar's total."""
    long = df.select(label, *items).unpivot([label], list(items), "item", "answer")
    long = long.filter(F.col("answer").isin([float(v) for v in range(lo, hi + 1)]))
    counts = long.groupBy("item", F.col("answer").cast("int").alias("answer"), label).agg(F.count(F.lit(1)).alias("n"))
    bar = Window.partitionBy("item", "answer")
    stack = bar.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumns(
        {
            "offset": F.coalesce(F.sum("n").over(stack), F.lit(0)).cast("long"),
            "total": F.sum("n").over(bar).cast("long"),
        }
    )
    # the y-axis maximum: one window over the aggregated bars (items x answers x clusters rows)
    return out.withColumn("max_total", F.max("total").over(Window.partitionBy()))


def correlations(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every ordered pair, rounded; one aggregation."""
    cols = list(cols)
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    r = df.agg(*aggs)
    pairs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = F.lit(1.0) if i == j else F.col(f"{min(i, j)}_{max(i, j)}")
            pairs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.round(v, digits).alias("corr")))
    return r.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def top_with_ties(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Row count by ``col``; the top n counts, ties kept (``rank``).

    The counts (one row per value) are written once; the n-th largest is the
    cut; the rank is a window over the at most n different counts above it."""
    from traitlab.session import scratch_table

    counts = scratch_table(df.groupBy(col).agg(F.count(F.lit(1)).alias("n")), "counts")
    cut = counts.orderBy(F.desc("n")).limit(n).agg(F.min("n")).first()[0]
    kept = counts.filter(F.col("n") >= F.lit(cut if cut is not None else 0))
    levels = kept.groupBy("n").agg(F.count("*").alias("_k"))
    more = F.coalesce(F.sum("_k").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = levels.select("n", (more + 1).cast("int").alias("rank"))
    return kept.join(F.broadcast(levels), "n").select(col, "n", "rank")


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of each column and row count per group (nulls ignored)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", value: str = "value") -> DataFrame:
    """A10: melt / pivot_longer."""
    return df.unpivot(list(ids), list(cols), var, value)


def top_groups(df: DataFrame, by: str, part: str, score: str, n: int = 5) -> DataFrame:
    """Top n rows per ``part`` by score (ties broken by ``by``)."""
    w = Window.partitionBy(part).orderBy(F.desc(score), F.asc(by))
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)


def correlation_ratio(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """eta^2 = between-group / total sum of squares, per feature.

    A first pass takes the means; the second works on values less their mean
    (so that large offsets do not cancel): per-group sums and squares, k rows
    per feature."""
    cols = list(cols)
    m = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centred = df.select(y, *[(F.col(c) - F.lit(float(m[f"m{i}"]) if m[f"m{i}"] is not None else 0.0)).alias(c) for i, c in enumerate(cols)])
    long = centred.unpivot([y], cols, "feature", "x").filter(F.col("x").isNotNull())
    g = long.groupBy("feature", y).agg(F.count(F.lit(1)).alias("ng"), F.sum("x").alias("sg"), F.sum(F.col("x") * F.col("x")).alias("qg"))
    t = g.groupBy("feature").agg(
        F.sum("ng").alias("n"),
        F.sum("sg").alias("s"),
        F.sum("qg").alias("q"),
        F.sum(F.col("sg") * F.col("sg") / F.col("ng")).alias("b"),
    )
    between = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    total = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    return t.select("feature", F.try_divide(between, total).alias("eta_sq"))


def quantiles(df: DataFrame, by: Sequence[str], col: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles per group (linear between neighbours, at place
    (n - 1) * share).  Different values are counted first; running counts in
    value order find the two values a place lies between.  A group with most
    of the rows is spread over many tasks."""
    value = F.col(col).cast("double")
    if not by:
        return quantiles(df.withColumn("_all", F.lit(0)), ["_all"], col, shares, names).drop("_all")
    by = list(by)
    rows = df.select(*by, value.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = rows.groupBy(*by, "_v").agg(F.count("*").alias("_c"))
    placed = running_sums(counts, by, ["_v"], "_c", "_upto")
    # the rows of a group: its largest running count
    sizes = placed.groupBy(*by).agg(F.max("_upto").alias("_n"))
    both = null_safe_join(placed, sizes, by)
    aggs = []
    for i, q in enumerate(shares):
        at = (F.col("_n") - 1) * F.lit(float(q))
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("_upto") - F.col("_c") <= place) & (place < F.col("_upto"))
            aggs.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{side}{i}"))
    found = both.groupBy(*by).agg(F.max("_n").alias("_n"), *aggs)
    part = [(F.col("_n") - 1) * F.lit(float(q)) - F.floor((F.col("_n") - 1) * F.lit(float(q))) for q in shares]
    return found.select(*by, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part[i]).alias(n) for i, n in enumerate(names)])


def five_numbers(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Exact min, quartiles, median, max per group."""
    return quantiles(df, by, col, [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"])


def kept_share(df: DataFrame, keep) -> DataFrame:
    """Rows before, kept, dropped and kept share in one aggregation."""
    return df.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(keep).alias("n_kept"),
    ).select(
        "n_before",
        "n_kept",
        (F.col("n_before") - F.col("n_kept")).alias("n_dropped"),
        F.try_divide(F.col("n_kept") * F.lit(100.0), F.col("n_before")).alias("kept_pct"),
    )


# ---------------------------------------------------------------- grid-result analyses

METRICS = ["calinski_harabasz", "davies_bouldin", "silhouette"]


def metric_means(grid: DataFrame, by: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean of each metric by the given keys (e.g. model, factor_analysis)."""
    return grid.groupBy(*by).agg(*[F.avg(m).alias(m) for m in metrics])


def best_config(grid: DataFrame, model: str = "model") -> DataFrame:
    """composite = min-max(silhouette) + min-max(cluster_entropy) over the
    whole table; the first maximum per model (ties: config_id).  The ranges
    are one global aggregate (literals); the per-model pick is a window over
    result rows (one per configuration)."""
    from traitlab.operators.features import minmax

    g = grid.filter(F.col("silhouette").isNotNull() & F.col("cluster_entropy").isNotNull())
    g = minmax(g, ["silhouette", "cluster_entropy"], suffix="_norm")
    g = g.withColumn("composite", F.col("silhouette_norm") + F.col("cluster_entropy_norm"))
    w = Window.partitionBy(model).orderBy(F.desc("composite"), "config_id")
    return g.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def global_max(grid: DataFrame, metric: str) -> DataFrame:
    """A15."""
    return grid.agg(F.max(metric).alias(f"max_{metric}"))


def compare_best(grid: DataFrame, metrics: Sequence[str] = METRICS, by: str = "factor_analysis", model: str = "model") -> DataFrame:
    """Per (switch, metric) the model with the highest mean is "best";
    every other model gets the symmetric % difference
    abs(a - b) / ((a + b) / 2) * 100, rounded to 1 (a maximum counts as best
    for every metric, Davies-Bouldin included)."""
    means = metric_means(grid, [by, model], metrics)
    long = means.unpivot([by, model], list(metrics), "metric", "value")
    w = Window.partitionBy(by, "metric").orderBy(F.desc("value"), model)
    ranked = long.withColumn("_r", F.row_number().over(w))
    best = ranked.filter(F.col("_r") == 1).select(by, "metric", F.col(model).alias("best_model"), F.col("value").alias("best_value"))
    others = ranked.filter(F.col("_r") > 1).drop("_r")
    j = others.join(best, [by, "metric"])
    diff = F.abs(F.col("best_value") - F.col("value")) / ((F.col("best_value") + F.col("value")) / 2) * 100
    return j.select(by, "metric", "best_model", F.col(model).alias("other_model"), F.bround(diff, 1).alias("pct_diff"))


def summary_sentences(cmp: DataFrame, by: str = "factor_analysis") -> DataFrame:
    """One sentence per (metric, switch) from the A16 table."""
    g = cmp.groupBy("metric", by, "best_model").agg(
        F.array_join(F.array_sort(F.collect_list(F.format_string("%s (%.1f%%)", F.col("other_model"), F.col("pct_diff")))), " and ").alias("others")
    )
    return g.select(
        "metric",
        by,
        F.format_string("For %s (%s = %s), %s is best, ahead of %s.", F.col("metric"), F.lit(by), F.col(by).cast("string"), F.col("best_model"), F.col("others")).alias("sentence"),
    )
