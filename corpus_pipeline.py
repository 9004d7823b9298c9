"""Training-corpus pipeline over ``documents``: quality rules, line dedup,
near-duplicate removal, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlab.llm import bpe, jaccard, lines, mixing, rules
from traitlab.llm.common import BROADCAST_ROWS, small, table, written
from traitlab.llm.queries import byte_bpe, token_digests

#: token shares by language; the total grows until no language has to shrink
WEIGHTS = {"en": 0.55, "fr": 0.175, "de": 0.175, "es": 0.1}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the cascade keep."""
    return rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; every row stays."""
    out = lines.dedup_lines(docs).drop("_n_lines", "_n_dropped")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies: sets of
    five-word shingles with similarity 0.8 or more."""
    groups = jaccard.jaccard_groups(docs, shingle=5, num=80, den=100)
    return jaccard.one_of_each(docs, groups)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rate (its fraction is drawn by a hash of
    the id), so that token shares of the languages approach WEIGHTS.  Rates
    count as 1 at least: no document is lost."""
    known = {r["lang"] for r in docs.select("lang").distinct().limit(mixing.MAX_DOMAINS + 1).collect()}
    rates = mixing.mix(docs, docs, "lang", {k: w for k, w in WEIGHTS.items() if k in known}, grow=True)
    draw = F.pmod(F.xxhash64("__mix_id", F.lit(5)), F.lit(1_000_000)) / 1_000_000
    times = rates.where("doc_id is not null").groupBy(F.col("doc_id").alias("__mix_id")).agg(F.max("rate").alias("__mix_rate"))
    times = written(times.select("__mix_id", F.floor(F.col("__mix_rate") + draw).cast("int").alias("__mix_times")).where("__mix_times > 1"), "times")
    joined = docs.join(small(times, 10 * BROADCAST_ROWS), docs["doc_id"] == times["__mix_id"], "left")
    again = F.explode(F.sequence(F.lit(1), F.coalesce("__mix_times", F.lit(1))))
    return joined.withColumn("__mix_copy", again).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding."""
    return token_digests(bpe.encode_decode(docs, byte_bpe()))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_languages),
    ("BPE encoding and decoding", encode),
]

#: the mixing stage's iteration and the encoding are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i}")
    return docs
