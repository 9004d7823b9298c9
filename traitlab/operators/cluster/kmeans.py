"""K-Means (C1-C3).

Two flavours:

* ``kmeans`` (parity / sql-k): Lloyd iterations where the k centroids (k*p
  numbers) live on the driver and travel as a broadcast; each iteration is
  one job of per-partition sums.  Lineage does not grow across iterations.
* ``kmeans_ml``: ``pyspark.ml.clustering.KMeans`` (k-means|| init).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.columns import arg_min, det, sq_dist
from traitlab.functions.vectors import INLINE_TERMS, best_position, matrix, squared_distances, summed, tasks_of, with_scores
from traitlab.session import scratch_table


@dataclass
class Centroids:
    cols: list[str]
    centers: list[list[float]]
    n_iter: int = 0
    shifts: list[float] = field(default_factory=list)

    def assign(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return assign_nearest(df, self.cols, self.centers, out)


def assign_nearest(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Index of the nearest centre (squared Euclidean; lowest index on ties)."""
    if len(cols) * len(centers) <= INLINE_TERMS:
        return df.withColumn(out, arg_min([sq_dist(cols, c) for c in centers]))
    scored = with_scores(df, cols, np.array(centers, dtype=float), lambda c, x: squared_distances(x, c), len(centers), "_dist")
    return scored.withColumn(out, (best_position("_dist", lowest=True) - 1).cast("int")).drop("_dist")


def init_first_rows(df: DataFrame, key: str, cols: Sequence[str], k: int, seed: int = 42) -> list[list[float]]:
    """Start centres: the first k rows by det(key) (a top-k, k rows to the driver)."""
    rows = df.select(*cols, det(key, seed).alias("_d"), F.col(key).alias("_k")).orderBy("_d", "_k").limit(k).collect()
    return [[float(r[c]) for c in cols] for r in rows]


def init_uniform_box(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42) -> list[list[float]]:
    """K points drawn uniformly in the bounding box (seeded)."""
    r = df.agg(*[x for c in cols for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).collect()[0]
    rng = np.random.default_rng(seed)
    lo = np.array([r[f"lo_{c}"] for c in cols], dtype=float)
    hi = np.array([r[f"hi_{c}"] for c in cols], dtype=float)
    return (lo + rng.random((k, len(cols))) * (hi - lo)).tolist()


def lloyd_step(df: DataFrame, cols: Sequence[str], centers: list[list[float]], tasks: int | None = None) -> list[list[float]]:
    """One Lloyd update; an empty cluster keeps its old centre.  Each task
    returns its sums (k x (p + 1) numbers) from vectorised distances: the
    centres travel as a broadcast, so a step needs no newly generated code.
    Rows with a null feature take no part.  Ties go to the lowest index, as in
    ``assign_nearest``."""
    cols, k = list(cols), len(centers)

    def part(c, batch):
        x = matrix(batch, cols)
        x = x[~np.isnan(x).any(axis=1)]
        total = np.zeros((k, len(cols) + 1))
        if len(x):
            near = squared_distances(x, c).argmin(axis=1)
            np.add.at(total, near, np.column_stack([x, np.ones(len(x))]))
        return total.ravel()

    total = summed(df.select(*cols), np.array(centers, dtype=float), part, k * (len(cols) + 1), tasks).reshape(k, -1)
    return [(t[:-1] / t[-1]).tolist() if t[-1] else list(c) for t, c in zip(total, centers)]


def kmeans(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    k: int = 5,
    max_iter: int = 100,
    tol: float = 1e-6,
    seed: int = 42,
    init: str | list[list[float]] = "first",
) -> Centroids:
    """Lloyd's algorithm; stops when the largest centre move is < tol.
    The features are written once and read by every step."""
    cols = list(cols)
    if isinstance(init, list):
        centers = init
    elif init == "box":
        centers = init_uniform_box(df, cols, k, seed)
    else:
        centers = init_first_rows(df, key, cols, k, seed)
    shifts = []
    it = 0
    data = scratch_table(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "kmeans")
    tasks = tasks_of(data)
    for it in range(1, max_iter + 1):
        new = lloyd_step(data, cols, centers, tasks)
        shift = max(float(np.linalg.norm(np.array(a) - np.array(b))) for a, b in zip(new, centers))
        shifts.append(shift)
        centers = new
        if shift < tol:
            break
    return Centroids(cols, centers, it, shifts)


def kmeans_ml(df: DataFrame, cols: Sequence[str], k: int = 5, max_iter: int = 100, tol: float = 1e-6, seed: int = 42, out: str = "cluster"):
    """C1 production path: Spark ML K-Means (k-means|| initialisation)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=list(cols), outputCol="_features")
    model = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol="_features", predictionCol=out).fit(va.transform(df))
    return model.transform(va.transform(df)).drop("_features"), model
