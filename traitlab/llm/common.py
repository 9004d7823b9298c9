"""Shared Spark helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlab.session import scratch_table

#: rows a side may have to be broadcast; beyond it the join shuffles
BROADCAST_ROWS = 400_000
#: rows of a batch whose Python objects are held at once
SLICE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again:
    lineage ends there and a lost executor costs no earlier stage."""
    return scratch_table(df, f"llm-{name}")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it
    is (the join then shuffles, and AQE splits hot keys).  ``df`` should be a
    written table, so that the count is a metadata read."""
    return F.broadcast(df) if df.count() <= rows else df


def map_batches(df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches given and returned as dicts of columns.  An
    Arrow batch is handed on in slices of ``SLICE`` rows, so that a worker
    holds the Python objects of few texts at a time."""
    spark = df.sparkSession
    out = spark.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        slices = (b.slice(i, SLICE).to_pydict() for b in batches for i in range(0, b.num_rows, SLICE))
        for cols in work(slices):
            yield pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def lists(arrays: list, kind=None) -> pa.Array:
    """A list column from NumPy arrays, without a Python object per value."""
    import numpy as np

    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64)
    if ends[-1] >= 2**31:
        raise ValueError("a batch's lists hold over 2^31 values; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    flat = flat.view(np.int64) if flat.dtype == np.uint64 else flat
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, type=kind or pa.int64()))


def table_offsets(df: DataFrame, part: str, size) -> DataFrame:
    """(part, before): the sum of ``size`` (an aggregate) over all smaller
    parts.  ``part`` numbers the tasks that wrote ``df``, so the driver holds
    one row per task."""
    rows = sorted((r[0], r[1]) for r in df.groupBy(part).agg(size).collect())
    out, total = [], 0
    for key, n in rows:
        out.append((key, total))
        total += n
    return df.sparkSession.createDataFrame(out, f"{part} long, before long")


def distinct_pairs(df: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each unordered pair of different ids once, smaller first."""
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def parts_for(rows: int, per_part: int = 100_000) -> int:
    """Partitions for so many narrow rows."""
    return max(1, -(-rows // per_part))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest id
    reachable.  Alternates large-star and small-star steps until no edge
    changes; each round's edges and minima are written tables, in partitions
    that follow the number of edges.  A hub's edges meet their minimum by
    broadcast if the minima are few, else in a join whose hot keys AQE
    splits."""
    links = written(distinct_pairs(edges).select(F.col("b").alias("hi"), F.col("a").alias("lo")), "edges")
    state, parts = None, None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            both = links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")))
            return both.groupBy("node").agg(F.min("root").alias("root"))
        state, parts = now, parts_for(now[0])
        both = links.select(F.col("hi").alias("x"), F.col("lo").alias("y")).unionByName(links.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
        least = written(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")).coalesce(parts), "least")
        large = both.where("y > x").join(small(least), "x").select(F.col("y").alias("hi"), F.col("m").alias("lo"))
        down = written(large.groupBy("hi").agg(F.min("lo").alias("m")).coalesce(parts), "down")
        moved = large.join(small(down), "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = written(moved.unionByName(down.select("hi", F.col("m").alias("lo"))).distinct().coalesce(parts), "edges")
