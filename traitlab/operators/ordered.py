"""Running sums in order, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.session import scratch_table


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` (a whole number, not
    negative) over the rows of the same ``keys`` up to and with this one, in
    the order of ``order``.  Rows equal in keys and order must be one row.

    The rows are range-sorted by group and order and a task adds up what it
    holds, so a group with most of the rows lies in many tasks.  The group that
    a task's range opens with may have begun before: its sum there (one number
    per task, on the driver) is added.  Groups are told apart by a 64-bit hash
    of their keys and sorted by it."""
    keyed = df.withColumn("_g", F.xxhash64(*keys) if keys else F.lit(0).cast("long"))
    schema = T.StructType([*keyed.schema.fields, T.StructField("_part", T.LongType()), T.StructField(out, T.LongType())])

    def work(batches):
        part, group, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g, v = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_g", value))
            sums = np.cumsum(v.astype(np.int64))
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            base = np.r_[0, sums][first]
            if g[0] == group:
                base[0] -= total
            sums = sums - np.repeat(base, np.diff(np.r_[first, len(g)]))
            group, total = g[-1], int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(g), part, dtype=np.int64)), pa.array(sums)], names=[*batch.schema.names, "_part", out])

    summed = scratch_table(keyed.repartitionByRange("_g", *order).sortWithinPartitions("_g", *order).mapInArrow(work, schema), "running")
    ends = summed.groupBy("_part").agg(F.min(F.struct("_g", (-F.col(out)).alias("s"))).alias("a"), F.max(F.struct("_g", out)).alias("b")).collect()
    carried, open_group, held = [], None, 0
    for part, (first, head), (last, tail) in sorted((r["_part"], (r["a"][0], -r["a"][1]), (r["b"][0], r["b"][1])) for r in ends):
        before = held if first == open_group else 0
        if before:
            carried.append((part, first, before))
        held = tail + before if first == last else tail
        open_group = last
    table = df.sparkSession.createDataFrame(carried, "_part long, _g long, _before long")
    return summed.join(F.broadcast(table), ["_part", "_g"], "left").withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_part", "_g", "_before")
