"""Sampling, splitting and balancing.

Every exact operator orders rows by the deterministic key
``det(row_id, seed)`` (ties by row id), the same order the SQL oracle uses.

Scale design: "the first n rows by det" is answered **without a global
sort and without a per-class window over raw rows**.  ``det`` is a
bijection of ``row_id mod 2**31``, so two histogram passes pin the exact cut
value: level 1 counts rows per (group, det >> 16) bucket (<= 32768 buckets
per group), level 2 counts rows per exact det value inside the one cut
bucket (<= 65536 values).  Only rows sharing the cut det value (row ids
that differ by multiples of 2**31, normally none) are ranked by row id.
The result is one cut (det*, row_id*) per group, collected only when the
number of groups is under a checked bound, then applied as a filter on a
broadcast of that bounded table.  A class holding a third of all rows costs
the same as any other: its rows are only counted, never sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitlab.functions.columns import det

MAX_GROUPS = 100_000  # bound on classes/strata whose cuts are collected


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Collect a small aggregate, failing loudly instead of pulling an unbounded result."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; refusing to collect")
    return rows


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Equi-join in which null matches null; ``on`` appears once (left's)."""
    names = {c: f"_on_{i}" for i, c in enumerate(on)}
    right = right.withColumnsRenamed(names)
    same = reduce(and_, [left[c].eqNullSafe(right[n]) for c, n in names.items()])
    return left.join(F.broadcast(right) if broadcast else right, same, how).drop(*names.values())


def _need_table(base: DataFrame, by: list[str], n: int | Callable[[Column], Column]) -> DataFrame:
    counts = base.groupBy(*by).agg(F.count(F.lit(1)).alias("_cnt"))
    need = n(F.col("_cnt")) if callable(n) else F.lit(int(n))
    return counts.withColumn("_need", F.least(need.cast("long"), F.col("_cnt")))


def first_n_cut(df: DataFrame, key: str, n: int | Callable[[Column], Column], seed: int = 42, by: Sequence[str] | None = None) -> DataFrame:
    """Per group: the cut (det*, key*) such that exactly ``need`` rows satisfy
    (det, key) <= (det*, key*).  Columns: by..., _cnt, _need, _dstar, _kstar
    (no group columns -> one constant group ``_g``)."""
    by = list(by or [])
    grp = by or ["_g"]
    base = df.select(*by, F.col(key).alias("_key"), det(key, seed).alias("_det"))
    if not by:
        base = base.withColumn("_g", F.lit(0))
    need = _need_table(base, grp, n)

    # level 1: buckets of 2**16 det values (<= 32768 histogram rows per group)
    h1 = base.groupBy(*grp, F.shiftright("_det", 16).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    w1 = Window.partitionBy(*grp).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    h1 = h1.withColumn("_cum", F.sum("_c").over(w1))
    h1 = null_safe_join(h1, need, grp)
    cut1 = h1.filter((F.col("_need") > 0) & (F.col("_cum") - F.col("_c") < F.col("_need")) & (F.col("_cum") >= F.col("_need")))
    cut1 = cut1.select(*grp, "_b", (F.col("_need") - (F.col("_cum") - F.col("_c"))).alias("_r1"))

    # level 2: exact det values inside the cut bucket (<= 65536 per group)
    inb = null_safe_join(base.withColumn("_b", F.shiftright("_det", 16)), cut1, grp + ["_b"])
    h2 = inb.groupBy(*grp, "_det", "_r1").agg(F.count(F.lit(1)).alias("_c"))
    w2 = Window.partitionBy(*grp).orderBy("_det").rowsBetween(Window.unboundedPreceding, 0)
    h2 = h2.withColumn("_cum", F.sum("_c").over(w2))
    cut2 = h2.filter((F.col("_cum") - F.col("_c") < F.col("_r1")) & (F.col("_cum") >= F.col("_r1")))
    cut2 = cut2.select(*grp, F.col("_det").alias("_dstar"), (F.col("_r1") - (F.col("_cum") - F.col("_c"))).alias("_r2"))

    # level 3: rows sharing the cut det value, ranked by key (collisions only)
    tie = null_safe_join(base, cut2, grp).filter(F.col("_det") == F.col("_dstar"))
    w3 = Window.partitionBy(*grp).orderBy("_key")
    tie = tie.withColumn("_rn", F.row_number().over(w3)).filter(F.col("_rn") == F.col("_r2"))
    cut3 = tie.select(*grp, "_dstar", F.col("_key").alias("_kstar"))
    return null_safe_join(need, cut3, grp, "left")


def _global_cut(df: DataFrame, key: str, n, seed: int) -> dict:
    """Global cut with three small aggregations collected to the driver:
    bucket counts (<= 2^17 rows: keys may be negative), exact det counts inside the cut bucket
    (<= 65536 rows), then the keys sharing the cut det value (collisions)."""
    base = df.select(F.col(key).alias("_key"), det(key, seed).alias("_det"))
    h1 = collect_bounded(base.groupBy(F.shiftright("_det", 16).alias("_b")).agg(F.count(F.lit(1)).alias("_c")), 1 << 17, "bucket counts")
    cnt = sum(int(r["_c"]) for r in h1)
    if callable(n):
        need = spark_eval_need(df.sparkSession, n, cnt)
    else:
        need = int(n)
    need = min(need, cnt)
    out = {"_cnt": cnt, "_need": need, "_dstar": None, "_kstar": None}
    if need <= 0 or need >= cnt:
        return out
    acc = 0
    for r in sorted(h1, key=lambda r: r["_b"]):
        if acc + r["_c"] >= need:
            b_star, r1 = int(r["_b"]), need - acc
            break
        acc += r["_c"]
    h2 = collect_bounded(base.filter(F.shiftright("_det", 16) == F.lit(b_star)).groupBy("_det").agg(F.count(F.lit(1)).alias("_c")), 1 << 16, "det counts")
    acc = 0
    for r in sorted(h2, key=lambda r: r["_det"]):
        if acc + r["_c"] >= r1:
            d_star, r2 = int(r["_det"]), r1 - acc
            break
        acc += r["_c"]
    ties = base.filter(F.col("_det") == F.lit(d_star)).select("_key").orderBy("_key").limit(r2).collect()
    out.update({"_dstar": d_star, "_kstar": ties[-1]["_key"]})
    return out


def spark_eval_need(spark, n, cnt: int) -> int:
    """Evaluate a need expression n(count) (a Column function) for a known count."""
    return int(spark.range(1).select(n(F.lit(cnt)).cast("long")).first()[0])


def first_n(df: DataFrame, key: str, n: int | Callable[[Column], Column], seed: int = 42, by: Sequence[str] | None = None, flag: str | None = None) -> DataFrame:
    """Rows that are among the first ``n`` by (det, key), per group ``by``.

    ``n`` is an int or a function of the group size Column.  With ``flag``
    every row is kept and ``flag`` tells whether it is in the first n."""
    by = list(by or [])
    d = det(key, seed)
    if not by:
        c = _global_cut(df, key, n, seed)
        if c["_need"] >= c["_cnt"]:
            inside = F.lit(True)
        elif c["_need"] <= 0 or c["_dstar"] is None:
            inside = F.lit(False)
        else:
            inside = (d < F.lit(c["_dstar"])) | ((d == F.lit(c["_dstar"])) & (F.col(key) <= F.lit(c["_kstar"])))
        return df.withColumn(flag, inside) if flag else df.filter(inside)
    from traitlab.session import scratch_table

    # one row per group, a null group included; broadcast while it is small
    cuts = scratch_table(first_n_cut(df, key, n, seed, by), "cuts")
    joined = null_safe_join(df, cuts, by, "left", broadcast=cuts.count() <= MAX_GROUPS)
    inside = (F.col("_need") >= F.col("_cnt")) | (
        (F.col("_need") > 0) & ((d < F.col("_dstar")) | ((d == F.col("_dstar")) & (F.col(key) <= F.col("_kstar"))))
    )
    inside = F.coalesce(inside, F.lit(False))
    out = joined.withColumn(flag, inside) if flag else joined.filter(inside)
    return out.drop("_cnt", "_need", "_dstar", "_kstar")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """B2: exactly min(n, count) rows (whole table when smaller)."""
    return first_n(df, key, n, seed)


def sample_frac(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """B1: ``int(count * frac)`` rows without replacement."""
    return first_n(df, key, lambda cnt: F.floor(cnt * F.lit(float(frac))), seed)


def sample_fast(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    """B1 fast path: Bernoulli sample, size only approximately frac * n."""
    return df.sample(withReplacement=False, fraction=frac, seed=seed)


def split(df: DataFrame, key: str, test: float = 0.2, stratify: str | None = None, seed: int = 42, out: str = "split") -> DataFrame:
    """Label each row 'train' or 'test'.

    Unstratified: test = ceil(test * n).  Stratified: round(test * n_class)
    per class (half up)."""
    if stratify is None:
        need = lambda cnt: F.ceil(cnt * F.lit(float(test)))
        flagged = first_n(df, key, need, seed, flag="_is_test")
    else:
        need = lambda cnt: F.round(cnt * F.lit(float(test)))
        flagged = first_n(df, key, need, seed, by=[stratify], flag="_is_test")
    return flagged.withColumn(out, F.when(F.col("_is_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_is_test")


def cap_classes(df: DataFrame, y: str, key: str, cap: int = 10_000, seed: int = 42) -> DataFrame:
    """Keep at most ``cap`` rows of every class."""
    return first_n(df, key, lambda cnt: F.least(cnt, F.lit(int(cap))), seed, by=[y])


def level_largest(df: DataFrame, y: str, key: str, seed: int = 42) -> DataFrame:
    """Cut the largest class down to the size of the second largest."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("c"))
    srt = collect_bounded(counts.orderBy(F.desc("c")).limit(2), 2, "level_largest")
    if len(srt) < 2:
        return df
    second = int(srt[1]["c"])
    return first_n(df, key, lambda cnt: F.least(cnt, F.lit(second)), seed, by=[y])


def class_counts(df: DataFrame, y: str) -> DataFrame:
    """B9."""
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """Balanced weight n / (k * n_c) attached to every row.

    The class table is one row per class; it is joined back with a broadcast
    after checking its size."""
    from traitlab.session import scratch_table

    counts = scratch_table(df.groupBy(y).agg(F.count(F.lit(1)).alias("_nc")), "class-counts")
    total, k = counts.agg(F.sum("_nc"), F.count("*")).first()
    weights = counts.select(y, (F.lit(float(total or 0)) / (F.lit(k) * F.col("_nc"))).alias(out))
    return null_safe_join(df, weights, [y], "left", broadcast=k <= MAX_GROUPS)


def bootstrap(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Exactly n draws with replacement.  Draw j takes the row whose rank
    by det is the MD5 of (seed, j) modulo n: counts per rank (aggregated
    before the join) say how often a row is repeated, so no draw is listed
    until its row is found."""
    ranked = det_rank(df, key, seed, out="_rank")
    n = df.count()
    if n == 0:
        return df
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))), 1, 15), 16, 10).cast("long") % F.lit(n)
    times = df.sparkSession.range(n).select(drawn.alias("_rank")).groupBy("_rank").agg(F.count("*").cast("int").alias("_times"))
    out = ranked.join(times, "_rank").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return out.drop("_rank", "_times", "_copy")


def bootstrap_fast(df: DataFrame, seed: int = 42) -> DataFrame:
    """B8 in one pass: a Poisson draw per row, expected size n."""
    return df.sample(withReplacement=True, fraction=1.0, seed=seed)


def perm_key(key: str, stream: int) -> Column:
    """An order key per permutation stream: ``key * m mod 2**31`` with an odd
    multiplier that depends on the stream (different seeds of ``det`` only
    rotate one cyclic order, which is useless for independent permutations)."""
    from traitlab.functions.columns import DET_ADD, DET_MOD

    m = perm_multiplier(stream)
    return ((F.col(key).cast("long") % F.lit(DET_MOD) * F.lit(m) + F.lit(DET_ADD)) % F.lit(DET_MOD)).cast("long")


def perm_multiplier(stream: int) -> int:
    """Odd multiplier below 2**31 for a permutation stream, spread over the
    whole range so that streams give unrelated orders."""
    from traitlab.functions.columns import DET_MOD, DET_MULT

    return ((DET_MULT * (2 * int(stream) + 1)) % DET_MOD) | 1


def det_rank(
    df: DataFrame, key: str, seed: int = 42, by: Sequence[str] | None = None, out: str = "rank", bits: int = 16, order: Column | None = None
) -> DataFrame:
    """0-based rank of each row by (det, key) within ``by``, without a
    single-partition window: offset of the det bucket + row_number inside it.
    ``order`` replaces det by another key in [0, 2**31).

    Rows are shuffled by (by, bucket); det is uniform, so a hot class is
    spread over all buckets."""
    by = list(by or [])
    shift = 31 - bits
    d = det(key, seed) if order is None else order
    base = df.withColumn("_det", d).withColumn("_b", F.shiftright("_det", shift))
    h = base.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = h.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    ranked = null_safe_join(base, offs, by + ["_b"], broadcast=not by)
    wr = Window.partitionBy(*by, "_b").orderBy("_det", key)
    return ranked.withColumn(out, (F.col("_off") + F.row_number().over(wr) - 1).cast("long")).drop("_det", "_b", "_off")


def folds(df: DataFrame, key: str, k: int = 3, stratify: str | None = None, seed: int = 42, out: str = "fold") -> DataFrame:
    """fold = rank by det mod k (per class when stratified)."""
    ranked = det_rank(df, key, seed, by=[stratify] if stratify else None, out="_rk")
    return ranked.withColumn(out, (F.col("_rk") % F.lit(k)).cast("int")).drop("_rk")
