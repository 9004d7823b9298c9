"""Vector work inside tasks: scores of many features per row, and sums of
arrays over all rows, as NumPy products over Arrow batches.  Formulas of some
hundred terms as column expressions outgrow what the JVM compiles; here the
parameters travel as one broadcast and the plan stays the same at any width."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: products of features and classes up to which column expressions are used
INLINE_TERMS = 128
#: doubles that the tasks of one step may send to the driver
DRIVER_DOUBLES = 100_000
#: doubles of a piece of the sums, and pieces, where tasks add up for the driver
PIECE, PIECES = 4_096, 32


def matrix(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    """Columns as a float matrix; null is NaN."""
    if not cols or not batch.num_rows:
        return np.empty((batch.num_rows, len(cols)))
    held = (batch.column(batch.schema.get_field_index(c)).cast(pa.float64()) for c in cols)
    return np.column_stack([v.to_numpy(zero_copy_only=False) for v in held])


def with_scores(df: DataFrame, cols: Sequence[str], params, score: Callable, width: int, out: str) -> DataFrame:
    """``df`` with ``out``, an array of ``width`` doubles: the rows of
    ``score(params, x)``; null where a feature is null or NaN."""
    shared = df.sparkSession.sparkContext.broadcast(params)
    cols = list(cols)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def work(batches):
        for batch in batches:
            x = matrix(batch, cols)
            bad = np.isnan(x).any(axis=1)
            values = np.asarray(score(shared.value, np.where(bad[:, None], 0.0, x)), dtype=float).reshape(len(x), width)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            arrays = pa.ListArray.from_arrays(ends, pa.array(values.ravel()), mask=pa.array(bad) if len(x) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, arrays], names=[*batch.schema.names, out])

    return df.mapInArrow(work, schema)


def tasks_of(data: DataFrame) -> int:
    """Number of tasks that read ``data``."""
    return data.rdd.getNumPartitions()


def summed(data: DataFrame, params, part: Callable, size: int, tasks: int | None = None) -> np.ndarray:
    """Sum over all Arrow batches of ``part(params, batch)``, a flat array of
    ``size`` doubles.  Every task adds up its own; the driver takes one row
    per task if ``tasks`` of them stay under ``DRIVER_DOUBLES``.  Else the sums
    are cut into pieces, a second stage adds up each piece (in the order of the
    tasks), and the driver takes ``size`` doubles, however many tasks there are."""
    shared = data.sparkSession.sparkContext.broadcast(params)
    direct = tasks is not None and tasks * size <= DRIVER_DOUBLES
    piece = max(PIECE, -(-size // PIECES))

    def work(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(shared.value, batch)
        if direct:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["v"])
        else:
            begin = range(0, size, piece)
            task = [TaskContext.get().partitionId()] * len(begin)
            yield pa.RecordBatch.from_arrays([pa.array(begin, pa.int64()), pa.array(task, pa.int64()), pa.array([total[i : i + piece].tobytes() for i in begin], pa.binary())], names=["at", "task", "v"])

    def add(batches):
        now, total = None, None
        for batch in batches:
            for at, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = np.frombuffer(v.as_buffer())
                if at == now:
                    total = total + v
                    continue
                if now is not None:
                    yield row(now, total)
                now, total = at, v
        if now is not None:
            yield row(now, total)

    def row(at, total):
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "v"])

    out = np.zeros(size)
    if direct:
        for r in data.mapInArrow(work, "v binary").collect():
            out += np.frombuffer(r["v"])
    else:
        parts = data.mapInArrow(work, "at long, task long, v binary").repartition(-(-size // piece), "at").sortWithinPartitions("at", "task")
        for r in parts.select("at", "v").mapInArrow(add, "at long, v binary").collect():
            out[r["at"] : r["at"] + piece] = np.frombuffer(r["v"])
    shared.unpersist()
    return out


def lifted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(A, B, slack): ``A @ B.T`` are the squared distances of the rows of a
    and b, each at most ``slack`` from those of the differences.  Where values
    are too large, or infinite, slack is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        mean = b.mean(axis=0) if len(b) else 0.0
        a, b = a - mean, b - mean
        na, nb = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
        slack = 8 * (a.shape[1] + 4) * np.finfo(float).eps * (na.max(initial=0.0) + nb.max(initial=0.0))
        one = np.ones
        sides = np.column_stack([a, na, one(len(a))]), np.column_stack([-2.0 * b, one(len(b)), nb])
    return *sides, float(slack) if np.isfinite(slack) else np.inf


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Rows x centres, from the differences (no cancellation)."""
    return np.stack([np.square(x - c).sum(axis=1) for c in centers], axis=1) if len(centers) else np.empty((len(x), 0))


def softmax_rows(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if z.size else z
    return e / e.sum(axis=1, keepdims=True) if z.size else z


def best_position(out: str, lowest: bool = False):
    """1-based position of the best value of an array column, the first on
    ties."""
    return F.array_position(out, (F.array_min if lowest else F.array_max)(out)).cast("int")


def best_label(classes: Sequence, out: str, lowest: bool = False):
    """Class at the best position; null where there are no scores."""
    labels = F.array(*[F.lit(c) for c in classes])
    return F.when(F.col(out).isNotNull(), F.element_at(labels, best_position(out, lowest)))
