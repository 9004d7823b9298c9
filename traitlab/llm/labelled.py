"""Bounded labelled samples: which rows may train, and the texts of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import written


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % mod


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, may_train: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """Written table (id, t, y) of about ``per_class`` labelled rows of either
    class among those ``may_train`` (of the column ``id``) allows, drawn by a
    hash of the id.  Labels other than 0 and 1 are left out; an id labelled
    twice counts with its smaller label.  ``per_class`` bounds what is
    broadcast and what a model is fitted on."""
    ids = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    ids = ids.where(may_train).groupBy("id").agg(F.min("y").alias("y"))
    count = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    share = [min(1.0, per_class / max(1, count.get(y, 0))) for y in (0, 1)]
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000))
    ids = ids.where(draw < F.when(F.col("y") == 1, F.lit(int(share[1] * 1_000_000))).otherwise(F.lit(int(share[0] * 1_000_000))))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return written(texts.join(F.broadcast(ids), "id"), "sample"), {y: count.get(y, 0) for y in (0, 1)}
