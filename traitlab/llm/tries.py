"""Prefix trie of rebuilt conversations (operator 12).

Conversation c is rebuilt from the first h turns of conversation c - c mod 100
and its own turns after its first h, h = crc32(decimal c) mod 6.  A turn is
known by the SHA-256 of its role and text; texts never leave the first scan.

A sequence of turns is known by the exclusive or of one 128-bit hash for each
(position, turn), so that prefixes extend in one pass over rows sorted by
conversation.  The pass cuts every conversation into blocks of ``block`` turns
and gives each its digests at entry and at exit.  Conversations are grouped by
these first: where all conversations that enter a block with one digest leave
it with one digest, the block is a single cell and all its turns share one
group.  Only where siblings leave with different digests is the block opened
and grouped turn by turn.  The turns of the cells are the nodes.

Every node is known by its smallest member and its depth.  A member owns the
nodes whose smallest member it is, one stretch of depths down to its end.
Hence sums over a subtree are sums over members: of one for each owner of a
childless node, and of the weights that each member owns, less what the node's
own smallest member owns above it.

No step holds a conversation or a group: rows are range-sorted (a conversation
may lie in many tasks, the driver passes one total per task on), groups are
pre-aggregated, and the ids of a group's ended members are hashed as a stream
of sorted chunks.

Edge cases: null roles and texts are empty; turns come null first, equal turns
in the order of their digests, repeated rows stay; rows without a conv_id
belong to no conversation; a conversation without rebuilt turns ends at the
root; very long conversations and texts are like others; an empty table has no
node; other columns, whatever their names, are not read."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.llm.common import map_batches, small, written

NODE = ("d", "z1", "z2")
#: bytes of a chunk of decimal ids
CHUNK = 4096


def carried(parts: list[tuple], add) -> list[tuple]:
    """(part, key, total before) of the keys that go on from one task to the
    next; ``parts`` holds (part, first key, its total, last key, its total)
    in order, one row per task."""
    out, key, total = [], None, None
    for part, first, head, last, tail in parts:
        if key == first and total is not None:
            out.append((part, first, total))
            total = add(total, tail) if first == last else tail
        else:
            total = tail
        key = last
    return out


def running(df: DataFrame, key: str, order: list, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` within ``key`` in the order of the columns
    ``order``, as column ``out``.  The rows are range-sorted; one task per
    range adds up, and the total of a key that goes on is carried."""
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.LongType()), T.StructField(out, T.LongType())])

    def run(batches):
        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            sums = np.cumsum(batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            before = np.r_[0, sums][begin]
            if keys[0] == last:
                before[0] -= total
            sums = sums - np.repeat(before, np.diff(np.r_[begin, len(keys)]))
            last, total = keys[-1], int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(keys), part)), pa.array(sums)], names=[*batch.schema.names, "_part", out])

    summed = written(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInArrow(run, schema), "running")
    # values are not negative, so a key's total in a task is its largest sum there
    ends = summed.groupBy("_part").agg(F.min(F.struct(key, (-F.col(out)).alias("s"))).alias("a"), F.max(F.struct(key, out)).alias("b")).collect()
    parts = sorted((r["_part"], r["a"][0], -r["a"][1], r["b"][0], r["b"][1]) for r in ends)
    before = df.sparkSession.createDataFrame(carried(parts, int.__add__), f"_part long, {key} long, _before long")
    return summed.join(F.broadcast(before), ["_part", key], "left").withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_part", "_before")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, h, base), and their rebuilt turns (c, d, x1, x2, ch):
    place, 128-bit hash of place and turn, code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("c"), "turn", digest.alias("dg"), F.length(text).alias("ch"))
    turns = written(turns.withColumn("u", F.monotonically_increasing_id()).withColumn("one", F.lit(1)), "turns")
    h, base = F.crc32(F.col("c").cast("string")) % 6, F.col("c") - F.pmod("c", F.lit(100))
    numbered = running(turns, "c", [F.asc_nulls_first("turn"), "dg", "u"], "one", "i").withColumns({"h": h, "base": base}).select("c", "i", "dg", "ch", "h", "base")
    convs = written(numbered.where("i = 1").select("c", "h", "base"), "convs")
    heads = written(numbered.where("c = base and i <= 5").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("i", "dg", "ch"))).alias("head")).withColumnRenamed("c", "base"), "heads")
    given = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)))
    own = numbered.where("i > h").join(heads, "base", "left").select("c", (F.col("i") - F.col("h") + given).alias("d"), "dg", "ch")
    lent = convs.where("h > 0").join(heads, "base").select("c", F.explode(F.slice("head", 1, F.col("h").cast("int"))).alias("t")).select("c", F.col("t.i").alias("d"), "t.dg", "t.ch")
    both = own.unionByName(lent)
    return convs, written(both.select("c", "d", F.xxhash64("d", "dg").alias("x1"), F.xxhash64(F.lit("second"), "dg", "d").alias("x2"), F.col("ch").cast("long").alias("ch")), "rebuilt")


def blocks(turns: DataFrame, block: int) -> DataFrame:
    """(c, k, p1, p2, q1, q2, y, ch): the blocks of every conversation with
    its digest at entry (p) and exit (q), the digests after each of the
    block's turns (y) and the turns' code points."""

    def work(batches):
        part, conv, at, now, two = TaskContext.get().partitionId(), None, None, None, (0, 0)
        for cols in batches:
            rows = []
            for c, d, x1, x2, ch in zip(cols["c"], cols["d"], cols["x1"], cols["x2"], cols["ch"]):
                k = (d - 1) // block
                if c != conv or k != at:
                    if now:
                        rows.append(now)
                    if c != conv:
                        two = (0, 0)
                    conv, at, now = c, k, (c, k, *two, [], [], [])
                two = (two[0] ^ x1, two[1] ^ x2)
                for held, v in zip(now[4:], (*two, ch)):
                    held.append(v)
            yield _columns(part, rows)
        yield _columns(part, [now] if now else [])

    def _columns(part, rows):
        names = ("c", "k", "p1", "p2", "y1", "y2", "ch")
        out = {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return out | {"part": [part] * len(rows), "q1": [r[4][-1] for r in rows], "q2": [r[5][-1] for r in rows]}

    schema = "part long, c long, k long, p1 long, p2 long, q1 long, q2 long, y1 array<long>, y2 array<long>, ch array<long>"
    ordered = turns.withColumn("k", F.floor((F.col("d") - 1) / block)).repartitionByRange("c", "k").sortWithinPartitions("c", "d").drop("k")
    cut = written(map_batches(ordered, work, schema), "blocks")
    ends = cut.groupBy("part").agg(F.min(F.struct("c", (-F.col("k")).alias("s"), "q1", "q2")).alias("a"), F.max(F.struct("c", "k", "q1", "q2")).alias("b")).collect()
    parts = sorted((r["part"], r["a"]["c"], (r["a"]["q1"], r["a"]["q2"]), r["b"]["c"], (r["b"]["q1"], r["b"]["q2"])) for r in ends)
    rows = [(p, c, *t) for p, c, t in carried(parts, lambda s, t: (s[0] ^ t[0], s[1] ^ t[1]))]
    before = turns.sparkSession.createDataFrame(rows, "part long, c long, e1 long, e2 long")
    joined = cut.join(F.broadcast(before), ["part", "c"], "left")
    enter = {i: F.coalesce(f"e{i}", F.lit(0)) for i in (1, 2)}
    fixed = {f"{n}{i}": F.col(f"{n}{i}").bitwiseXOR(enter[i]) for n in "pq" for i in (1, 2)}
    y = F.zip_with("y1", "y2", lambda a, b: F.struct(a.bitwiseXOR(enter[1]).alias("z1"), b.bitwiseXOR(enter[2]).alias("z2")))
    return written(joined.select("c", "k", *[v.alias(n) for n, v in fixed.items()], y.alias("y"), "ch"), "blocks")


def members(cut: DataFrame, block: int) -> DataFrame:
    """One row per conversation and cell it passes: (c, d, z1, z2) name the
    cell's last node, p1 and p2 its entry, y and ch its turns.  A block is one
    cell unless conversations that enter it alike leave it differently; then
    each of its turns is a cell."""
    leave = F.struct("q1", "q2")
    split = cut.groupBy("k", "p1", "p2").agg(F.min(leave).alias("a"), F.max(leave).alias("b")).where("a != b").select("k", "p1", "p2", F.lit(True).alias("split"))
    marked = cut.join(small(written(split, "split")), ["k", "p1", "p2"], "left")
    one = F.struct(F.size("y").alias("j"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), "y", "ch")
    steps = F.transform(
        F.sequence(F.lit(1), F.size("y")),
        lambda j: F.struct(
            j.alias("j"),
            F.when(j > 1, F.get("y", j - 2)["z1"]).otherwise(F.col("p1")).alias("b1"),
            F.when(j > 1, F.get("y", j - 2)["z2"]).otherwise(F.col("p2")).alias("b2"),
            F.slice("y", j, 1).alias("y"),
            F.slice("ch", j, 1).alias("ch"),
        ),
    )
    cell = marked.select("c", "k", F.explode(F.when(F.col("split"), steps).otherwise(F.array(one))).alias("s"))
    last = F.element_at("s.y", -1)
    return written(cell.select("c", (F.col("k") * block + F.col("s.j")).alias("d"), last["z1"].alias("z1"), last["z2"].alias("z2"), F.col("s.b1").alias("p1"), F.col("s.b2").alias("p2"), "s.y", "s.ch"), "members")


def ended(cut: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """(d, z1, z2, ends_sha256) of the nodes where conversations end."""
    last = cut.groupBy("c").agg(F.max(F.struct((F.col("k") * block + F.size("y")).alias("d"), F.col("q1").alias("z1"), F.col("q2").alias("z2"))).alias("e"))
    at = written(convs.select("c").join(last, "c", "left").select("c", *[F.coalesce(f"e.{n}", F.lit(0).cast("long")).alias(n) for n in NODE]), "ends")
    counts = written(at.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("c").alias("c")), "end-counts")
    single = counts.where("n = 1").select(*NODE, F.sha2(F.col("c").cast("string"), 256).alias("ends_sha256"))
    many = at.join(small(counts.where("n > 1").select(*NODE)), list(NODE))

    def chunks(batches):
        node, text, first = None, [], None
        for cols in batches:
            out = []
            for d, z1, z2, c in zip(cols["d"], cols["z1"], cols["z2"], cols["c"]):
                if node != (d, z1, z2) or len(text) * 20 >= CHUNK:
                    if text:
                        out.append((*node, first, ",".join(text)))
                    node, text, first = (d, z1, z2), [], c
                text.append(str(c))
            yield _rows(out)
        yield _rows([(*node, first, ",".join(text))] if text else [])

    def _rows(rows):
        return {n: [r[i] for r in rows] for i, n in enumerate((*NODE, "first", "ids"))}

    def hashes(batches):
        node, state = None, None
        for cols in batches:
            out = []
            for d, z1, z2, ids in zip(cols["d"], cols["z1"], cols["z2"], cols["ids"]):
                if node != (d, z1, z2):
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = (d, z1, z2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield {n: [r[i] for r in out] for i, n in enumerate((*NODE, "ends_sha256"))}
        yield {n: [r[i] for r in ([(*node, state.hexdigest())] if state else [])] for i, n in enumerate((*NODE, "ends_sha256"))}

    name = "d long, z1 long, z2 long"
    sorted_ids = written(many, "many").repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c").select(*NODE, "c")
    chunked = map_batches(sorted_ids, chunks, f"{name}, first long, ids string")
    return single.unionByName(map_batches(chunked.repartition(*NODE).sortWithinPartitions(*NODE, "first"), hashes, f"{name}, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, block: int = 4) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(conversations)
    cut = blocks(turns, block)
    passed = members(cut, block)
    cells = passed.groupBy(*NODE).agg(F.min("c").alias("rep"), F.count("*").alias("n"), F.first(F.struct("p1", "p2", "y", "ch")).alias("s"))
    # a cell's turns: each follows the one before, the first the cell's entry
    entry = F.struct(F.col("s.p1").alias("z1"), F.col("s.p2").alias("z2"))
    lines = F.arrays_zip(F.col("s.y").alias("z"), F.concat(F.array(entry), F.col("s.y")).alias("p"), F.col("s.ch").alias("ch"))
    cell = F.struct(*NODE).alias("cell")
    opened = cells.select("rep", "n", cell, F.col("d").alias("end"), F.size("s.y").alias("m"), F.posexplode(F.slice(lines, 1, F.size("s.y"))).alias("j", "t"))
    nodes = opened.select((F.col("end") - F.col("m") + F.col("j") + 1).alias("d"), F.col("t.z.z1").alias("z1"), F.col("t.z.z2").alias("z2"), F.col("t.p.z1").alias("p1"), F.col("t.p.z2").alias("p2"), "rep", "n", F.col("t.ch").alias("ch"), "cell")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("c").alias("rep"), F.count("*").alias("n")).where("n > 0").select(zero.alias("d"), zero.alias("z1"), zero.alias("z2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "rep", "n", zero.alias("ch"), F.struct(*[zero.alias(n) for n in NODE]).alias("cell"))
    nodes = written(nodes.unionByName(root).withColumn("w", (F.col("n") - 1) * F.col("ch")), "nodes")

    kids = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("z1"), F.col("p2").alias("z2")).agg(F.count("*").alias("n_children"))
    counted = written(nodes.join(kids, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", zero)), "counted")
    owned = written(counted.groupBy("rep").agg(F.sum("w").alias("total"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")).withColumnRenamed("rep", "c"), "owned")
    sums = passed.select("c", F.struct(*NODE).alias("cell")).join(owned, "c", "left").groupBy("cell").agg(F.sum("leaf").alias("leaves"), F.sum("total").alias("below"))
    all_ = owned.agg(F.sum("leaf").alias("leaves"), F.sum("total").alias("below")).where("leaves is not null").select(F.struct(*[zero.alias(n) for n in NODE]).alias("cell"), "leaves", "below")
    # what the smallest member owns above a node is not below it
    shared = running(counted.where("n > 1"), "rep", ["d"], "w", "run")
    alone = counted.where("n = 1").withColumn("run", F.lit(None).cast("long"))
    full = shared.unionByName(alone).join(sums.unionByName(all_), "cell", "left").join(ended(cut, convs, block), list(NODE), "left")
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("z1").alias("p1"), F.col("z2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    return full.join(parents, ["d", "p1", "p2"], "left").select(
        F.col("rep").alias("conv_id"),
        F.col("d").alias("depth"),
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.coalesce("leaves", zero).alias("n_leaves"),
        F.when(F.col("n") > 1, F.coalesce("below", zero) - F.col("run") + F.col("w")).otherwise(zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
