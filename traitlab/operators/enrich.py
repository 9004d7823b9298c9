"""Enrichment and joins.

Dimension joins broadcast the dimension (fixed size).  Data-derived lookup
tables are joined with a broadcast only after their row count is checked;
the neighbour self-join (E8) is an equi-join on grid cells, never a cross
join."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.operators.sample import MAX_GROUPS
from traitlab.session import scratch_table


def _small(dim: DataFrame) -> DataFrame:
    """A dimension, broadcast if its size allows."""
    return F.broadcast(dim) if dim.limit(MAX_GROUPS + 1).count() <= MAX_GROUPS else dim


def join_country(df: DataFrame, dim: DataFrame, on: str = "country") -> DataFrame:
    """Left join to the country dimension on the ISO code."""
    return df.join(_small(dim), on, "left")


def attach_question(long: DataFrame, dim: DataFrame, item: str = "item") -> DataFrame:
    """Question text by item id (long form)."""
    return long.join(_small(dim.select(F.col("id").alias(item), "question")), item, "left")


def fold_rare(df: DataFrame, col: str, into: str, min_count: int = 5000, out: str | None = None) -> DataFrame:
    """Values with fewer than ``min_count`` rows are replaced by ``into``
    (a null ``into`` keeps the value; a null value is never rare).  The table
    of rare values is joined, by broadcast while it is small."""
    rare = scratch_table(df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_rare")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < min_count).select("_rare"), "rare")
    side = F.broadcast(rare) if rare.count() <= MAX_GROUPS else rare
    value = F.when(F.col("_rare").isNotNull(), F.coalesce(F.col(into), F.col(col))).otherwise(F.col(col))
    return df.join(side, df[col] == rare["_rare"], "left").withColumn(out or col, value).drop("_rare")


def glue_labels(frames: Sequence[DataFrame], key: str, names: Sequence[str], label: str = "cluster") -> DataFrame:
    """E5: labels of several runs side by side, joined on the key; raises when
    the runs do not cover the same number of rows."""
    counts = [f.count() for f in frames]
    if len(set(counts)) != 1:
        raise ValueError(f"label runs differ in row count: {counts}")
    out = frames[0].select(key, F.col(label).alias(names[0]))
    for f, n in zip(frames[1:], names[1:]):
        out = out.join(f.select(key, F.col(label).alias(n)), key)
    return out


def join_map(dim: DataFrame, df: DataFrame, on: str) -> DataFrame:
    """Keep every dimension row, attach the data side."""
    return dim.join(df, on, "left")


def attach_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """E7."""
    return df.join(labels, key)


def eps_pairs(df: DataFrame, key: str, cols: Sequence[str], eps: float, with_self: bool = True, grid_dims: int = 3) -> DataFrame:
    """All pairs (i, j) with Euclidean distance <= eps.

    Points are put in grid cells of side eps over the first ``grid_dims``
    columns; each point is replicated to its 3^g neighbouring cells and
    joined to the points *in* that cell by an equi-join on the cell, then the
    exact distance over all columns is filtered.  Exact for any g: two points
    within eps differ by at most eps in every coordinate.  g <= 3 caps the
    replication at 27x; work is proportional to near pairs, not n^2."""
    d = len(cols)
    g = max(1, min(d, grid_dims))
    cell = [F.floor(F.col(c) / F.lit(float(eps))).cast("long") for c in cols[:g]]
    pts = df.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(cols)], *[x.alias(f"_g{i}") for i, x in enumerate(cell)])
    offsets = list(itertools.product([-1, 0, 1], repeat=g))
    off = F.explode(F.array(*[F.array(*[F.lit(o) for o in t]) for t in offsets])).alias("_off")
    left = pts.select("*", off).select(
        F.col("_k").alias("i"),
        *[F.col(f"_x{j}").alias(f"_a{j}") for j in range(d)],
        *[(F.col(f"_g{j}") + F.col("_off")[j]).alias(f"_g{j}") for j in range(g)],
    )
    right = pts.select(F.col("_k").alias("j"), *[F.col(f"_x{j}").alias(f"_b{j}") for j in range(d)], *[f"_g{j}" for j in range(g)])
    pairs = left.join(right, [f"_g{j}" for j in range(g)])
    diffs = [F.col(f"_a{j}") - F.col(f"_b{j}") for j in range(d)]
    dist2 = sum((x * x for x in diffs[1:]), diffs[0] * diffs[0])
    pairs = pairs.filter(dist2 <= F.lit(float(eps) ** 2))
    if not with_self:
        pairs = pairs.filter(F.col("i") != F.col("j"))
    return pairs.select("i", "j", F.sqrt(dist2).alias("dist"))
