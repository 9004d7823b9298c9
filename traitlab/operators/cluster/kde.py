"""KDE enrichment per cluster (C14).

Density of the data at each cluster centre with a Gaussian kernel and
Scott's bandwidth, compared with the density of null data sets in which
every column is permuted independently (dependence between columns
destroyed, marginals kept).  enrichment = real / mean(null);
p = (1 + #null >= real) / (B + 1).

The rows are ranked once (exactly, by the order key).  A permutation of
[0, n) is r -> (a r + c) mod n with a prime to n, another a and c for every
null set and column: a bijection that needs no sort.  Every value then knows
its places in all null sets, and one shuffle by (null set, place) puts the
null rows together.  Densities are per-task sums over centres (K numbers)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.vectors import matrix, squared_distances, summed
from traitlab.operators.cluster.quality import centroids
from traitlab.operators.sample import det_rank
from traitlab.session import scratch_table

#: products below this stay in 64 bits
_LONG = 1 << 62


def scott_bandwidth(df: DataFrame, cols: Sequence[str]) -> float:
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(c) for c in cols]).first()
    sd = sum(float(r[c]) for c in cols) / len(cols)
    return sd * float(r["n"]) ** (-1.0 / (len(cols) + 4))


def _prime(n: int) -> bool:
    """Trial division (n is about 2**31)."""
    return n % 2 == 1 and all(n % f for f in range(3, int(n**0.5) + 1, 2))


def multiplier(stream: int) -> int:
    """A prime above 2**31 for a stream, so prime to every smaller count."""
    p = 2**31 + 1 + (stream * 7_919_191) % 2**30 * 2
    while not _prime(p):
        p += 2
    return p


def offset(stream: int) -> int:
    return (stream * 2_654_435_761 + 12_345) % 2**31


def place(rank, n: int, stream: int):
    """Column: the place of a rank in the permutation of a stream."""
    a = multiplier(stream)
    while n % a == 0:  # n is a multiple of the prime: take the next one
        a += 2
        while not _prime(a):
            a += 2
    if a * n < _LONG:
        return (rank * F.lit(a) + F.lit(offset(stream))) % F.lit(n)
    wide = rank.cast("decimal(19,0)") * F.lit(a % n).cast("decimal(19,0)") + F.lit(offset(stream)).cast("decimal(19,0)")
    return F.pmod(wide, F.lit(n).cast("decimal(19,0)")).cast("long")


def stream_of(b: int, j: int) -> int:
    return 1000 * b + j


def null_sets(df: DataFrame, key: str, cols: Sequence[str], n_null: int) -> DataFrame:
    """(_b, _at, columns...): ``n_null`` null data sets, each column permuted
    on its own."""
    cols = list(cols)
    ranked = scratch_table(det_rank(df.select(key, *cols), key, out="_rk").select("_rk", *cols), "ranked")
    n = ranked.count()
    every = [F.struct(F.lit(b).alias("_b"), place(F.col("_rk"), max(n, 1), stream_of(b, j)).alias("_at"), F.lit(j).alias("_j"), F.col(c).cast("double").alias("_v")) for b in range(1, n_null + 1) for j, c in enumerate(cols)]
    long = ranked.select(F.explode(F.array(*every)).alias("e")).select("e.*")
    return long.groupBy("_b", "_at").agg(*[F.max(F.when(F.col("_j") == j, F.col("_v"))).alias(c) for j, c in enumerate(cols)])


def _kernels(params, x: np.ndarray) -> np.ndarray:
    mu, h = params
    return np.exp(-squared_distances(x, mu) / (2.0 * h * h)).sum(axis=0)


def kde_enrichment(df: DataFrame, key: str, cols: Sequence[str], label: str = "cluster", n_null: int = 20) -> DataFrame:
    """(cluster, density, null_mean, enrichment, p_value) per cluster."""
    cols, spark = list(cols), df.sparkSession
    cents = centroids(df, cols, label)
    params = (np.array(list(cents.values())), scott_bandwidth(df, cols))
    n, k = df.count(), len(cents)
    real = summed(df.select(*cols), params, lambda p, batch: _kernels(p, matrix(batch, cols)), k) / max(n, 1)
    shared = spark.sparkContext.broadcast(params)

    def work(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            b, x = batch.column(batch.schema.get_field_index("_b")).to_numpy(zero_copy_only=False), matrix(batch, cols)
            for v in np.unique(b):
                total[int(v)] = total.get(int(v), 0.0) + _kernels(shared.value, x[b == v])
        rows = [(b, i, float(s)) for b, sums in total.items() for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], names=["b", "i", "s"])

    sums = null_sets(df, key, cols, n_null).mapInArrow(work, "b int, i int, s double").groupBy("b", "i").agg((F.sum("s") / max(n, 1)).alias("nd"))
    known = spark.createDataFrame([(i, c, float(d)) for (i, c), d in zip(enumerate(cents), real)], f"i int, cluster {df.schema[label].dataType.simpleString()}, density double")
    agg = sums.join(F.broadcast(known), "i").groupBy("cluster", "density").agg(F.avg("nd").alias("null_mean"), F.count_if(F.col("nd") >= F.col("density")).alias("n_ge"))
    return agg.select("cluster", "density", "null_mean", F.try_divide("density", "null_mean").alias("enrichment"), ((F.col("n_ge") + 1) / F.lit(float(n_null + 1))).alias("p_value"))
