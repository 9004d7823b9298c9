"""Embedding near-dedup with random-hyperplane sign hashing (operator 9).

Vectors with one label and one length are compared.  Equal vectors are
collapsed to one representative with a multiplicity.  In each of several
tables a vector's code is the signs of its products with random hyperplanes;
vectors that share a table's code are candidates, each pair being taken in the
first table in which it meets, and links are kept if the exact cosine in
double precision reaches the threshold.  The number of bits follows the row
count (so that codes stay selective) and the number of tables follows from the
bits and the wanted ``recall`` of a pair that lies exactly at the threshold;
closer pairs are found more surely.

Edge cases: a null label, or a vector that is null, empty, zero or holds null
or non-finite components, links with nothing (0 links, its own component,
kept); a null id links with nothing and has a null component; rows that repeat
an id and vector are copies of one another; an empty table gives an empty
result."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import connected_components, lists, map_batches, small, written


def plan_tables(rows: int, threshold: float, recall: float, least_bits: int = 10, most_bits: int = 24) -> tuple[int, int]:
    """(bits, tables) for so many vectors to compare."""
    bits = int(np.clip(math.ceil(math.log2(max(rows, 2))), least_bits, most_bits))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _coded(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(rep, copies, label, unit, codes): unit vectors and their table codes."""

    def work(batches):
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for cols in batches:
            units, codes = [], []
            for vector in cols["vector"]:
                x = np.asarray(vector, dtype=np.float64)
                x = x / np.abs(x).max()
                x = x / np.sqrt(x @ x)
                d = len(x)
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, tables * bits))
                units.append(x)
                codes.append(((x @ planes[d]).reshape(tables, bits) > 0) @ weights)
            import pyarrow as pa

            yield {"rep": cols["rep"], "copies": cols["copies"], "label": cols["label"], "unit": lists(units, pa.float64()), "codes": lists(codes)}

    return map_batches(reps, work, "rep long, copies long, label string, unit array<double>, codes array<long>")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, recall: float = 0.9999, seed: int = 20240229) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(F.coalesce(usable, F.lit(False)), F.col(label_col).cast("string")).alias("label"), x.alias("vector"))
    # a 128-bit name of (label, vector): equal vectors share it
    rows = rows.withColumn("name", F.when(F.col("label").isNotNull(), F.md5(F.concat_ws("|", "label", F.concat_ws(",", F.col("vector").cast("array<string>"))))))
    reps = written(rows.where("label is not null").groupBy("name").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")), "vectors")
    # representatives of different vectors may share an id that is repeated; the name tells them apart
    n = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    bits, tables = plan_tables(n or 2, threshold, recall)
    coded = written(_coded(reps, bits, tables, seed), "codes")
    at = coded.select("rep", "copies", "label", "unit", "codes", F.posexplode("codes").alias("t", "code"))
    key = ["label", "d", "t", "code"]
    at = at.withColumn("d", F.size("unit"))
    a = at.select(*key, F.col("rep").alias("a"), F.col("copies").alias("ca"), F.col("unit").alias("ua"), F.col("codes").alias("xa"))
    b = at.select(*key, F.col("rep").alias("b"), F.col("copies").alias("cb"), F.col("unit").alias("ub"), F.col("codes").alias("xb"))
    first = F.array_position(F.zip_with("xa", "xb", lambda p, q: p == q), True) == F.col("t") + 1
    cosine = F.aggregate(F.zip_with("ua", "ub", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    links = written(a.join(b, key).where((F.col("a") < F.col("b")) & first).where(cosine >= threshold).select("a", "b", "ca", "cb"), "links")
    degree = links.select(F.col("a").alias("rep"), F.col("cb").alias("n")).unionByName(links.select(F.col("b").alias("rep"), F.col("ca").alias("n"))).groupBy("rep").agg(F.sum("n").alias("others"))
    roots = connected_components(links.select("a", "b"))
    found = reps.select("name", "rep", "copies").join(degree, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    classes = written(found.select("name", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "classes")
    out = rows.select("id", "name").join(small(classes), "name", "left")
    root = F.coalesce("root", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"))
