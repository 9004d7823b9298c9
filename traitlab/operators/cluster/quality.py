"""Internal cluster-quality metrics.

Every metric is one or two aggregation passes whose results have one row per
cluster (K rows, collected under a size bound), on values less their overall
mean.  The squared-distance silhouette (Spark's ``ClusteringEvaluator``
definition) is exact and O(n*K), and the default of ``cluster_quality``; the
Euclidean one has no closed form and takes all distances, block by block."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.functions.vectors import lifted, matrix, summed, with_scores
from traitlab.operators.sample import MAX_GROUPS, collect_bounded
from traitlab.session import scratch_table

#: vectors in a block of the Euclidean silhouette, at least, where they make few blocks
SILHOUETTE_ROWS = 1_000
#: blocks that larger inputs are dealt into, and bytes of a block beyond which they are more
BLOCKS, BLOCK_BYTES = 24, 16 << 20
#: doubles of cluster sums that a task holds and the driver takes
MAX_SUMS = 20_000_000


def cluster_sums(df: DataFrame, cols: Sequence[str], label: str) -> dict:
    """label -> (rows, sum vector, sum of squared norms) about the overall
    mean, and the mean under the key ``None, "mean"``: the metrics are
    shift-invariant, sums of squares of large offsets are not.  Each task adds
    up its rows per label (one row per label leaves it); two passes."""
    cols, p = list(cols), len(cols)
    labels = [r[0] for r in collect_bounded(df.select(label).distinct(), MAX_GROUPS, "clusters")]
    if len(labels) * (p + 2) > MAX_SUMS:
        raise ValueError(f"{len(labels)} clusters of {p} features")
    mean = np.array([float(v) if v is not None else 0.0 for v in df.agg(F.array(*[F.avg(c) for c in cols])).first()[0]])
    place = {v: i for i, v in enumerate(labels)}

    def work(batches):
        total = np.zeros((len(labels), p + 2))
        for batch in batches:
            x = matrix(batch, cols) - mean
            at = np.array([place[v] for v in batch.column(batch.schema.get_field_index(label)).to_pylist()], dtype=np.int64)
            np.add.at(total, at, np.column_stack([np.ones(len(x)), x, np.square(x).sum(axis=1)]))
        seen = np.flatnonzero(total[:, 0])
        flat = pa.array(total[seen].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.ListArray.from_arrays(pa.array(np.arange(len(seen) + 1, dtype=np.int32) * (p + 2)), flat)], names=["at", "s"])

    long = df.select(label, *cols).mapInArrow(work, "at long, s array<double>").select("at", F.posexplode("s").alias("i", "v"))
    out = np.zeros((len(labels), p + 2))
    for r in long.groupBy("at", "i").agg(F.sum("v").alias("v")).collect():
        out[r["at"], r["i"]] = r["v"]
    return {None: mean} | {(v,): (row[0], row[1:-1], row[-1]) for v, row in zip(labels, out)}


def _one_row(df: DataFrame, name: str, value: float | None) -> DataFrame:
    return df.sparkSession.createDataFrame([(None if value is None else float(value),)], f"{name} double")


def calinski_harabasz_frame(df: DataFrame, cols: Sequence[str], label: str = "cluster", zero_within: float = 0.0) -> DataFrame:
    """C9 as a one-row DataFrame, from the cluster sums:
    between = sum_k |s_k|^2/n_k - |sum_k s_k|^2/n ; within = sum q - sum_k |s_k|^2/n_k."""
    rows = [v for k, v in cluster_sums(df, cols, label).items() if k is not None]
    k, n = len(rows), sum(r[0] for r in rows)
    if k < 2:
        return _one_row(df, "calinski_harabasz", -1.0)
    held = sum(float(r[1] @ r[1]) / r[0] for r in rows)
    every = sum(r[1] for r in rows)
    between, within = held - float(every @ every) / n, sum(r[2] for r in rows) - held
    value = float(zero_within) if within <= 0 else None if n == k else (between / (k - 1)) / (within / (n - k))
    return _one_row(df, "calinski_harabasz", value)


def calinski_harabasz(df: DataFrame, cols: Sequence[str], label: str = "cluster", zero_within: float = 0.0) -> float:
    """(between / (K-1)) / (within / (n-K)); ``zero_within`` when within is 0; -1 for one cluster."""
    return float(calinski_harabasz_frame(df, cols, label, zero_within).first()[0])


def centroids(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> dict:
    sums = cluster_sums(df, cols, label)
    mean = sums.pop(None)
    return {k[0]: (r[1] / r[0] + mean).tolist() for k, r in sums.items()}


def davies_bouldin_frame(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> DataFrame:
    """C10 as a one-row DataFrame.  Pass 1: centroids.  Pass 2: every task adds
    up the distances of its rows to their own centroid.  The ratios are taken
    over the K centroids."""
    cents = centroids(df, cols, label)
    if len(cents) < 2:
        return _one_row(df, "davies_bouldin", math.inf)
    mu, place, cols = np.array(list(cents.values())), {k: i for i, k in enumerate(cents)}, list(cols)

    def part(mu, batch):
        at = np.array([place[v] for v in batch.column(batch.schema.get_field_index(label)).to_pylist()], dtype=np.int64)
        dist = np.sqrt(np.square(matrix(batch, cols) - mu[at]).sum(axis=1))
        return np.concatenate([np.bincount(at, dist, minlength=len(mu)), np.bincount(at, minlength=len(mu))])

    total = summed(df.select(label, *cols), mu, part, 2 * len(mu)).reshape(2, -1)
    scatter = total[0] / total[1]
    worst = []
    for i in range(len(mu)):
        gap = np.sqrt(np.square(mu - mu[i]).sum(axis=1))
        far = gap > 0
        worst.append(((scatter[far] + scatter[i]) / gap[far]).max(initial=0.0))
    return _one_row(df, "davies_bouldin", float(np.mean(worst)))


def davies_bouldin(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> float:
    """Mean over clusters of max_j (s_i + s_j) / d(c_i, c_j); scatter =
    mean distance to the centroid; pairs at zero distance are skipped;
    +inf for one cluster."""
    return float(davies_bouldin_frame(df, cols, label).first()[0])


def clusters_found_frame(df: DataFrame, label: str = "cluster", noise: int = -1) -> DataFrame:
    """C11: distinct labels other than noise."""
    return df.filter(F.col(label) != F.lit(noise)).agg(F.count_distinct(label).alias("n_clusters_found"))


def clusters_found(df: DataFrame, label: str = "cluster", noise: int = -1) -> int:
    return int(clusters_found_frame(df, label, noise).first()[0])


def cluster_entropy_frame(df: DataFrame, label: str = "cluster") -> DataFrame:
    """-sum p ln p over cluster shares (natural log; noise counts as a group)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("nl"))
    # -sum (n/t) ln(n/t) = ln t - (1/t) sum n ln n
    return tot.select((F.log("t") - F.col("nl") / F.col("t")).alias("cluster_entropy"))


def cluster_entropy(df: DataFrame, label: str = "cluster") -> float:
    return float(cluster_entropy_frame(df, label).first()[0])


def silhouette_sq_frame(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> DataFrame:
    """C13 (scalable variant): silhouette with *squared* Euclidean distance.

    Mean squared distance from x to cluster C is |x|^2 - 2 x.mu_C + mean_C|y|^2,
    so a point needs only the K cluster sums, which travel as a broadcast:
    O(n*K).  Singleton clusters score 0; one cluster gives -1."""
    sums = cluster_sums(df, cols, label)
    mean = sums.pop(None)
    if len(sums) < 2:
        return _one_row(df, "silhouette_sq", -1.0)
    keys = [k[0] for k in sums]
    n = np.array([r[0] for r in sums.values()])
    mu = np.array([r[1] for r in sums.values()]) / n[:, None]
    q = np.array([r[2] for r in sums.values()]) / n

    def distances(params, x):
        mean, mu, q = params
        x = x - mean
        return np.square(x).sum(axis=1)[:, None] - 2.0 * x @ mu.T + q

    scored = with_scores(df.select(label, *cols), cols, (mean, mu, q), distances, len(keys), "_d")
    return _silhouette(scored, label, "_d", keys, n, "silhouette_sq")


def _silhouette(scored: DataFrame, label: str, dist: str, keys: list, n: np.ndarray, name: str, times: str | None = None) -> DataFrame:
    """Mean silhouette from each row's mean distance to every cluster, its own
    included (the own mean is taken over the other members)."""
    own = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(i)) for i, k in enumerate(keys)])
    sizes = F.array(*[F.lit(float(v)) for v in n])
    staged = scored.withColumn("_own", own).withColumn("_n", F.get(sizes, F.col("_own")))
    a = F.try_divide(F.get(dist, F.col("_own")) * F.col("_n"), F.col("_n") - 1)
    b = F.array_min(F.filter(dist, lambda _, i: i != F.col("_own")))
    staged = staged.select(a.alias("a"), b.alias("b"), "_n", (F.col(times) if times else F.lit(1)).alias("c"))
    s = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return staged.agg((F.sum(s * F.col("c")) / F.sum("c")).alias(name))


def silhouette_sq(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> float:
    return float(silhouette_sq_frame(df, cols, label).first()[0])


def silhouette_frame(df: DataFrame, cols: Sequence[str], label: str = "cluster", block: int | None = None) -> DataFrame:
    """C13 Euclidean silhouette (singleton -> 0), exact at any size.

    This form has no closed formula: every different (cluster, vector), with
    its count, is measured against all others, O(n^2) distances.  The vectors
    are dealt by hash into blocks (of about ``block``, or ``BLOCKS`` of them,
    more where a block would outgrow ``BLOCK_BYTES``); each pair of blocks
    meets once, in a task that holds these two, and gives every vector of both
    its sums of distances per cluster.  So a vector is sent once per block, and
    blocks follow the input's bytes only where memory asks for it.  Copies are
    one entry.  ``silhouette_sq`` needs O(n*K)."""
    p = len(cols)
    data = df.select(F.col(label).alias("l"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    points = scratch_table(data.groupBy("l", "x").agg(F.count("*").alias("c")).withColumn("id", F.monotonically_increasing_id()), "silhouette")
    sizes = collect_bounded(points.groupBy("l").agg(F.sum("c").alias("n"), F.count("*").alias("m")), MAX_GROUPS, "clusters")
    if len(sizes) < 2:
        return _one_row(df, "silhouette", -1.0)
    keys, k, m = [r["l"] for r in sizes], len(sizes), sum(r["m"] for r in sizes)
    blocks = -(-m // block) if block else max(min(BLOCKS, -(-m // SILHOUETTE_ROWS)), -(-m * 8 * (p + 2 * k + 4) // BLOCK_BYTES))
    own = F.coalesce(*[F.when(F.col("l").eqNullSafe(F.lit(v)), F.lit(i)) for i, v in enumerate(keys)])
    mine, other = F.pmod(F.xxhash64("l", "x"), F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("at")
    dealt = points.select(mine, "id", own.alias("o"), "c", "x").select("*", other)
    pairs = dealt.select(F.least("b", "at").alias("i"), F.greatest("b", "at").alias("j"), (F.col("b") > F.col("at")).alias("second"), "id", "o", "c", "x")
    tasks = blocks * (blocks + 1) // 2
    met = pairs.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "second", "id").mapInArrow(_meet_blocks(p, k), "id long, i long, j long, o int, c long, d array<double>")
    n = np.array([float(r["n"]) for r in sizes])
    whole = met.repartition(tasks, "id").sortWithinPartitions("id", "i", "j").mapInArrow(_add_meetings(k, n), "o int, c long, d array<double>")
    scored = whole.withColumn("l", F.get(F.array(*[F.lit(v) for v in keys]), F.col("o")))
    return _silhouette(scored, "l", "d", keys, np.array([r["n"] for r in sizes]), "silhouette", times="c")


def _get(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _vectors(batch, name: str, width: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def distance_sums(a: np.ndarray, b: np.ndarray, by_a: np.ndarray, by_b: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the rows of a and b, summed with the weights ``by_b`` per
    row of a and, if ``both``, with ``by_a`` per row of b.  They come from
    products; those so small that a product's rounding would show are taken
    from the differences."""
    left, right, slack = lifted(a, b)
    sums, others = np.zeros((len(a), by_b.shape[1])), np.zeros((len(b), by_a.shape[1]))
    for i in range(0, len(a), 256):
        for j in range(0, len(b), 1024):
            x, y = slice(i, i + 256), slice(j, j + 1024)
            d = left[x] @ right[y].T
            low, high = np.nonzero(~(d > 1e9 * slack))
            for at in range(0, len(low), 65_536):
                u, v = low[at : at + 65_536], high[at : at + 65_536]
                d[u, v] = np.square(a[i + u] - b[j + v]).sum(axis=1)
            np.sqrt(d, out=d)
            sums[x] += d @ by_b[y]
            if both:
                others[y] += d.T @ by_a[x]
    return sums, others


def _meet_blocks(p: int, k: int):
    """Rows (i, j, second, id, o, c, x), all of a pair of blocks together ->
    per vector its sums of distances to the clusters in the other block."""

    def weights(o, c):
        w = np.zeros((len(o), k))
        w[np.arange(len(o)), o] = c
        return w

    def meet(pair, held):
        sides = [[np.concatenate(z) for z in zip(*rows)] if rows else None for rows in held]
        a, b = sides if pair[0] != pair[1] else (sides[0], sides[0])
        if a is None or b is None:
            return
        sums = distance_sums(a[3], b[3], weights(*a[1:3]), weights(*b[1:3]), a is not b)
        for (ident, o, c, _), d in zip((a,) if a is b else (a, b), sums):
            for at in range(0, len(ident), 8192):
                s = slice(at, at + 8192)
                size = len(ident[s])
                yield pa.RecordBatch.from_arrays([pa.array(ident[s]), pa.array(np.full(size, pair[0])), pa.array(np.full(size, pair[1])), pa.array(o[s].astype(np.int32)), pa.array(c[s]), _lists(d[s])], names=["id", "i", "j", "o", "c", "d"])

    def work(batches):
        now, held = None, ([], [])
        for batch in batches:
            if not batch.num_rows:
                continue
            i, j, second = (_get(batch, n) for n in ("i", "j", "second"))
            data = _get(batch, "id"), _get(batch, "o"), _get(batch, "c"), _vectors(batch, "x", p)
            change = np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (second[1:] != second[:-1])) + 1
            for s, e in zip([0, *change], [*change, len(i)]):
                if now != (pair := (int(i[s]), int(j[s]))):
                    if now is not None:
                        yield from meet(now, held)
                    now, held = pair, ([], [])
                held[int(second[s])].append([v[s:e].copy() for v in data])
        if now is not None:
            yield from meet(now, held)

    return work


def _add_meetings(k: int, n: np.ndarray):
    """Rows sorted by id -> per vector its mean distances to the clusters."""

    def finish(o, c, d):
        return pa.RecordBatch.from_arrays([pa.array(o.astype(np.int32)), pa.array(c.astype(np.int64)), _lists(d / n)], names=["o", "c", "d"])

    def work(batches):
        rest = None  # the last vector of a batch may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [_get(batch, "id"), _get(batch, "o"), _get(batch, "c"), _vectors(batch, "d", k)]
            if rest is not None:
                cols = [np.concatenate(z) for z in zip(rest, cols)]
            begin = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            ident, o, c = (v[begin] for v in cols[:3])
            d = np.add.reduceat(cols[3], begin, axis=0)
            rest = [ident[-1:], o[-1:], c[-1:], d[-1:]]
            if len(ident) > 1:
                yield finish(o[:-1], c[:-1], d[:-1])
        if rest is not None:
            yield finish(*rest[1:])

    return work


def silhouette(df: DataFrame, cols: Sequence[str], label: str = "cluster") -> float:
    return float(silhouette_frame(df, cols, label).first()[0])


def cluster_quality(df: DataFrame, cols: Sequence[str], label: str = "cluster", exact_silhouette: bool = False) -> dict:
    """All metrics with the degenerate-label guard (one cluster ->
    CH -1, DB +inf, silhouette -1); noise -1 counts as a cluster."""
    k = int(df.agg(F.count_distinct(label)).collect()[0][0])
    if k < 2:
        return {"calinski_harabasz": -1.0, "davies_bouldin": math.inf, "silhouette": -1.0, "n_clusters_found": clusters_found(df, label), "cluster_entropy": cluster_entropy(df, label)}
    return {
        "calinski_harabasz": calinski_harabasz(df, cols, label),
        "davies_bouldin": davies_bouldin(df, cols, label),
        "silhouette": silhouette(df, cols, label) if exact_silhouette else silhouette_sq(df, cols, label),
        "n_clusters_found": clusters_found(df, label),
        "cluster_entropy": cluster_entropy(df, label),
    }
