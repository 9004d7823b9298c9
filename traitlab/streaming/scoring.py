"""Scoring of new responses (R1-R3) and model persistence.

The model is small (scaler: 2p numbers, centres: k*p numbers) and is
applied as column expressions, so batch and streaming scoring are the same
stateless projection.  Streaming reads arriving files with
``readStream`` (explicit schema), scores each micro-batch and appends to a
Parquet sink; the checkpoint lives under ``spark.checkpoint.dir``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from traitlab.operators.clean import answered_count
from traitlab.operators.cluster.kmeans import assign_nearest
from traitlab.operators.features import Scaler
from traitlab.session import checkpoint_dir


@dataclass
class ClusterScorer:
    """Scale the score columns, then the nearest cluster centre."""

    cols: list[str]
    scaler: Scaler
    centers: list[list[float]]

    @property
    def zcols(self) -> list[str]:
        return [f"{c}_z" for c in self.cols]

    def transform(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        z = self.scaler.transform(df, suffix="_z")
        return assign_nearest(z, self.zcols, self.centers, out).drop(*self.zcols)

    def to_json(self) -> str:
        return json.dumps({"cols": self.cols, "mean": self.scaler.mean, "std": self.scaler.std, "centers": self.centers})

    @staticmethod
    def from_json(text: str) -> "ClusterScorer":
        d = json.loads(text)
        return ClusterScorer(d["cols"], Scaler(d["cols"], d["mean"], d["std"]), d["centers"])

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON record written with the DataFrame writer."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ClusterScorer":
        return ClusterScorer.from_json(spark.read.text(path).first()[0])


def score_batch(model: ClusterScorer, df: DataFrame, out: str = "cluster") -> DataFrame:
    """Scale + nearest centre for a batch of responses."""
    return model.transform(df, out)


def score_safe(model: ClusterScorer, df: DataFrame, required: Sequence[str], out: str = "cluster") -> DataFrame:
    """A row with missing required answers becomes an error record
    (cluster null, ``error`` text) instead of failing the job."""
    n = answered_count(required)
    ok = n == F.lit(len(required))
    scored = model.transform(df, out)
    return scored.withColumns(
        {
            out: F.when(ok, F.col(out)),
            "error": F.when(~ok, F.format_string("incomplete response: %d of %d answers", n, F.lit(len(required)))),
        }
    )


def score_stream(
    spark: SparkSession,
    model: ClusterScorer,
    source_dir: str,
    schema: T.StructType,
    sink_dir: str,
    prepare=None,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """R2: score files arriving in ``source_dir`` into a Parquet sink.

    ``prepare`` is an optional DataFrame -> DataFrame step applied before
    scoring (e.g. cleaning and trait scores).  Stateless, so exactly-once
    comes from the file sink plus the checkpoint."""
    base = checkpoint or f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))  # bounded micro-batches
    stream = reader.parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    scored = model.transform(stream)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", base).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_dir)
