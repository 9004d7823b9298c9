"""Packing along a curve, conversation prefix trie, conversation repair:
against brute force, with the edge cases the modules state."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import with_clashes
from traitlab.llm import packing, repair, tries
from traitlab.llm.queries import byte_bpe

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


# ------------------------------------------------------------------ packing


def library_ids(text):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(byte_bpe()).encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def check_pieces(rows, docs, size):
    """Pieces restore every document; sequences are gapless and unpadded."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    by_id = {}
    for i, text in docs:
        by_id.setdefault(i, []).append(library_ids(text))
    for i, all_ids in by_id.items():
        if len(all_ids) > 1:  # rows that share an id: their pieces cover all of them
            assert sum(r["length"] for r in rows if r["doc_id"] == i) == sum(map(len, all_ids))
            continue
        at, ids = 0, all_ids[0]
        for r in sorted(pieces[(i, len(ids))], key=lambda r: r["start"]):
            assert r["start"] == at and zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size and at & (at - 1) == 0
    return sequences


def test_packing_restores_every_document(spark, docs):
    rows = packing.pack(docs, byte_bpe()).collect()
    sequences = check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 1024)
    short = [s for s in sequences.values() if sum(r["length"] for r in s) < 1024]
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert len(short) <= 10 * int(tasks)


def test_packing_edge_cases(spark, no_docs, docs):
    assert packing.pack(no_docs, byte_bpe()).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, byte_bpe(), size=1000)
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, " " * 3000), (5, "x" * 5000), (6, "One sentence here. " * 4000), (7, "tie"), (8, "tie"), (None, "no id")]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    out = packing.pack(df, byte_bpe(), size=64).collect()
    check_pieces(out, rows, 64)
    assert [r["doc_tokens"] for r in out if r["doc_id"] in (1, 2)] == [1, 1]


def test_parts_of_long_texts_encode_alone():
    text = "Some words, and more   of them.\n\n" * 300 + "y" * 500
    encode = packing.Ids(byte_bpe())
    parts = list(packing.text_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 50
    assert np.concatenate([np.array(encode.encode(p), dtype="<u4") for p in parts]).tolist() == library_ids(text)[:-1].tolist()


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    key = packing.hilbert(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_in_a_sequence_are_alike(spark):
    rng = random.Random(5)
    topics = [[f"{p}{i}" for i in range(60)] for p in ("alpha", "beta", "gamma")]
    rows = [(i, " ".join(rng.choice(topics[i % 3]) for _ in range(60))) for i in range(240)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), byte_bpe()).orderBy("sequence_id", "offset").collect()
    pairs = [(a["doc_id"] % 3, b["doc_id"] % 3) for a, b in zip(out, out[1:]) if a["sequence_id"] == b["sequence_id"] and a["doc_id"] != b["doc_id"]]
    assert sum(a == b for a, b in pairs) > 0.8 * len(pairs)


# ------------------------------------------------------------------ conversations


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def conversations(seed=3, n=260):
    """Shared openings, copies, repeated turns, nulls, one long conversation."""
    rng = random.Random(seed)
    say = ["Hello there.", "What is it?", "", None, "no end", "Yes! ", "  ", "Fine.\n", "é 漢字."]
    rows = []
    for c in range(n):
        if c % 17 == 5:
            continue
        for t in range(rng.randrange(0, 11)):
            role = rng.choice(["user", "assistant", "system", "tool", None]) if rng.random() < 0.3 else ("user", "assistant")[t % 2]
            rows.append((c, None if rng.random() < 0.03 else t, role, rng.choice(say[:3]) if t < 3 else rng.choice(say)))
    rows += [(700 + i, t, r, x) for i in range(40) for t, (r, x) in enumerate([("user", "Same."), ("assistant", "Same too.")])]
    rows += [(900, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)] + [(901, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(650)]
    rows += [(903, 1, "user", "again.")] * 9 + [(None, 0, "user", "no id."), (None, 1, "assistant", "none.")]
    return rows


def brute_trie(rows):
    found = {}
    for c, t, r, x in rows:
        if c is not None:
            found.setdefault(c, []).append(((t is not None, t or 0), digest(r or "", x or ""), (r or "", x or "")))
    own = {c: [v[2] for v in sorted(held)] for c, held in found.items()}
    full = {c: tuple(own.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + own[c][h:]) for c in own}
    nodes, kids = {}, {}
    for c, s in full.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for s in nodes:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(nodes, key=len, reverse=True):
        below = kids.get(s, [])
        leaves[s] = sum(leaves[k] for k in below) or 1
        saved[s] = sum(saved[k] for k in below) + ((len(nodes[s]) - 1) * len(s[-1][1]) if s else 0)
        ends = ",".join(map(str, sorted(c for c in nodes[s] if len(full[c]) == len(s))))
        out.append((min(nodes[s]), len(s), min(nodes[s[:-1]]) if s else None, len(nodes[s]), len(below), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("block", [1, 4, 7])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(tries, "CHUNK", 64)  # the ids of ended members fill several chunks
    rows = conversations()
    df = with_clashes(spark.createDataFrame(rows, CONV).repartition(3))
    got = sorted((tuple(r) for r in tries.prefix_trie(df, block).collect()), key=lambda r: r[:2])
    assert got == brute_trie(rows)


def test_trie_edge_cases(spark):
    assert tries.prefix_trie(spark.createDataFrame([], CONV)).collect() == []
    assert tries.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], CONV)).collect() == []
    # a conversation whose turns are all replaced by those of an absent one
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(lone, 0, "user", "x"), (lone, 1, None, None)]
    assert [tuple(r) for r in tries.prefix_trie(spark.createDataFrame(rows, CONV)).collect()] == brute_trie(rows)
    assert len(brute_trie(rows)) == 1


def test_carried_totals():
    parts = [(0, "a", 2, "b", 3), (1, "b", 4, "b", 4), (2, "b", 1, "c", 5), (5, "d", 1, "d", 1)]
    assert tries.carried(parts, int.__add__) == [(1, "b", 3), (2, "b", 7)]


WHITE = " \t\n\x0b\f\r"


def damage_rows(rows):
    out = {}
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        held = out.setdefault(c, [])
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            held += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def brute_audit(rows):
    """Least (cost, audit) over whole strings, row by row."""
    after = lambda s: "a" if s == "u" else "u"

    def put(d, s, v):
        d[s] = min(d.get(s, v), v)

    def insert(d):
        d = dict(d)
        for _ in range(3):
            for s, (c, a) in list(d.items()):
                put(d, after(s), (c + 5, a + "I"))
        return d

    now = {"": (0, "")}
    for role, fault in rows:
        new = {}
        for s, (c, a) in insert(now).items():
            put(new, s, (c + 2, a + "D"))
            if fault not in ("blank", "duplicate"):
                c += 5 * (fault == "truncated")
                put(new, after(s), (c + 1, a + "R"))
                if role[:1] == after(s) or (role[:1] == "s" and s == ""):
                    put(new, role[:1], (c, a + "K"))
        now = new
    return min(v for s, v in insert(now).items() if s in ("", "a"))


def brute_repair(rows):
    out = []
    for c, held in damage_rows(rows).items():
        held = sorted(held, key=lambda q: ((q[0] is not None, q[0] or 0), q[1], digest(q[1], q[2])))
        seen, faults = set(), []
        for _, r, x in held:
            bare = x.rstrip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((r, x))
        turns = [t for t, _, _ in held if t is not None]
        cost, audit = brute_audit([(r, f) for (_, r, _), f in zip(held, faults)])
        state, lines, rest = "", [], iter(held)
        for e in audit:
            _, r, x = next(rest) if e != "I" else (0, "", "")
            if e != "D":
                state = "s" if e == "K" and r[:1] == "s" else "a" if state == "u" else "u"
                lines.append((r if e == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + x)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def repaired(df):
    return repair.repair(repair.faulted(repair.damaged(df), F.col("present")))


@pytest.mark.parametrize("piece", [8192, 3])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    """Also with conversations cut into pieces of three rows."""
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = conversations()
    out = repaired(with_clashes(spark.createDataFrame(rows, CONV).repartition(3)))
    got = sorted((tuple(r) for r in out.digests().collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == brute_repair(rows)
    lines = {}
    for r in out.turns().orderBy("part", "piece", "seq", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in lines.items()} == {r[0]: r[-1] for r in got if r[-1] != hashlib.sha256(b"").hexdigest()}


def test_search_equals_brute_force_on_random_rows():
    rng = random.Random(8)
    for _ in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "", "u"]), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(0, 14))]
        cost, audit = repair.solve([(r[:1], f) for r, f in rows])
        assert (cost, "".join(audit)) == brute_audit(rows), rows


def test_repair_edge_cases(spark):
    assert repaired(spark.createDataFrame([], CONV)).digests().collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "dropped."), (2000, None, None, None), (2001, None, "user", "x" * 2_000_000 + ".")]
    got = sorted(tuple(r) for r in repaired(spark.createDataFrame(rows, CONV)).digests().collect())
    assert got == brute_repair(rows)
    assert got[0][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# ------------------------------------------------------------------ registered queries on the given tables

SF = "/root/testdata/sf0.001"


def test_registered_queries_equal_brute_force(spark):
    from traitlab.llm.queries import QUERIES

    convs = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    trie = sorted((tuple(r) for r in QUERIES["op12_conversation_trie"](spark, SF).collect()), key=lambda r: r[:2])
    assert trie == brute_trie(convs)
    assert sorted(tuple(r) for r in QUERIES["op13_conversation_repair"](spark, SF).collect()) == brute_repair(convs)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(QUERIES["op11_curve_packing"](spark, SF).collect(), docs, 1024)
