"""Substring dedup with a count-min prefilter (operator 5).

A window is ``size`` consecutive words.  Every window is stood for by its
least ``gram``-word hash (its minimiser): equal windows have equal minimisers,
at different places for different starts.  Pass one counts, per partition, the
chosen places in the slots of a count-min sketch (two rows of saturating
counters); the partitions' sketches are merged slice by slice into one bit per
slot, "counted twice or more".  Estimates never fall below the true count, so
pass two, which takes only windows whose minimiser is estimated repeated,
loses no repeated window.  These are grouped exactly by a 64-bit window hash;
the first occurrence of each group (smallest id, then start) goes back to its
document, and every other candidate is a repeat whose words are removed.

The sketch has ``slots_per_place`` slots for each expected place, up to
``max_sketch_mb``: that bounds what is broadcast.  Past the bound (over about
three GB of text for 64 MB) more windows pass the filter and the exact grouping
does more work, with the same result.

Edge cases: a null or empty text has no words; fewer words than a window: all
kept; rows that share an id are one document and get the same marks; a row
with a null id takes no part and is returned whole; an empty table gives an
empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import map_batches, small, written
from traitlab.llm.text import mix, window_hashes, word_hashes

_U = np.uint64
_ROWS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SLICE_BITS = 22
FLUSH = 1_000_000


def _sliding(x: np.ndarray, size: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every run of ``size`` values."""
    have, out = 1, x
    while have * 2 <= size:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return op(out[:-rest], out[rest:]) if rest else out


def minimisers(words: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least ``gram`` hash of every window, and the hashes at all places that
    are the least of some window."""
    g = window_hashes(words, gram)
    span = size - gram + 1
    if len(g) < span:
        return g[:0], g[:0]
    least = _sliding(g, span, np.minimum)
    pad = np.zeros(span - 1, dtype=np.uint64)
    reach = _sliding(np.concatenate([pad, least, pad]), span, np.maximum)
    return least, g[reach == g]


def slot(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(values * _U(_ROWS[row])) >> _U(64 - bits)).astype(np.int64)


def sketch_bits(docs: DataFrame, size: int, gram: int, slots_per_place: float, max_sketch_mb: int) -> int:
    """log2 of the slots in a sketch row."""
    chars = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    places = max(1, chars / 6.5 * 2 / (size - gram + 2))
    most = int(np.log2(max_sketch_mb * 2**20 * 8 / len(_ROWS)))
    return int(np.clip(np.ceil(np.log2(places * slots_per_place)), 16, most))


def repeated_slots(docs: DataFrame, size: int, gram: int, bits: int) -> list[bytes]:
    """Per sketch row, a bitmap of the slots counted twice or more."""
    cut = min(SLICE_BITS, bits)

    def count(batches):
        held, n = [], 0

        def flush():
            values = np.concatenate(held) if held else np.empty(0, np.uint64)
            out = {"slice": [], "slots": [], "twice": []}
            for row in range(len(_ROWS)):
                at, count = np.unique(slot(values, row, bits), return_counts=True)
                edges = np.flatnonzero(np.diff(at >> cut, prepend=-1))
                for lo, hi in zip(edges, [*edges[1:], len(at)]):
                    out["slice"].append(int(at[lo] >> cut) + (row << (bits - cut)))
                    out["slots"].append((at[lo:hi] & ((1 << cut) - 1)).astype(np.uint32).tobytes())
                    out["twice"].append(np.packbits(count[lo:hi] > 1).tobytes())
            return out

        for cols in batches:
            for text in cols["t"]:
                places = minimisers(word_hashes((text or "").encode("utf-8", "surrogatepass"))[0], size, gram)[1]
                held.append(places)
                n += len(places)
            if n > FLUSH:
                yield flush()
                held.clear()
                n = 0
        yield flush()

    def merge(key: tuple[pa.Scalar, ...], frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(1 << cut, dtype=bool), np.zeros(1 << cut, dtype=bool)
        for frame in frames:
            for slots, twice in zip(frame.column("slots").to_pylist(), frame.column("twice").to_pylist()):
                at = np.frombuffer(slots, dtype=np.uint32)
                again[at[seen[at]]] = True
                again[at[np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=len(at)).astype(bool)]] = True
                seen[at] = True
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": [np.packbits(again, bitorder="little").tobytes()]})

    counted = map_batches(docs.where("id is not null").select("t"), count, "slice long, slots binary, twice binary")
    merged = written(counted.groupBy("slice").applyInArrow(merge, "slice long, bits binary"), "sketch")
    empty = bytes(max(1, (1 << cut) // 8))
    maps = [bytearray((1 << bits) // 8) for _ in _ROWS]
    per = 1 << (bits - cut)
    for r in merged.toLocalIterator():  # at most max_sketch_mb in all
        row, part = divmod(r["slice"], per)
        maps[row][part * len(empty) : (part + 1) * len(empty)] = r["bits"]
    return [bytes(m) for m in maps]


def _candidates(words: np.ndarray, maps: list[np.ndarray], size: int, gram: int, bits: int) -> np.ndarray:
    """Starts of the windows estimated repeated."""
    least = minimisers(words, size, gram)[0]
    ok = np.ones(len(least), dtype=bool)
    for row, bitmap in enumerate(maps):
        at = slot(least, row, bits)
        ok &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return np.flatnonzero(ok)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 20, gram: int = 8, slots_per_place: float = 4.0, max_sketch_mb: int = 64) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` holds the words no earlier
    window covers, joined by one space."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    bits = sketch_bits(picked, size, gram, slots_per_place, max_sketch_mb)
    shared = spark.sparkContext.broadcast(repeated_slots(picked, size, gram, bits))

    def windows(batches):
        maps = [np.frombuffer(m, dtype=np.uint8) for m in shared.value]

        def firsts(hashes, ids, starts):
            h, d, p = np.concatenate(hashes), np.concatenate(ids), np.concatenate(starts)
            order = np.lexsort((p, d, h))  # the first of each hash among these
            keep = order[np.flatnonzero(np.diff(h[order], prepend=h[order][:1] ^ _U(1)))]
            keep.sort()
            return {"h": _long(h[keep]), "d": _long(d[keep]), "p": _int(p[keep])}

        for cols in batches:
            held: tuple[list, list, list] = ([], [], [])
            n = 0
            for key, text in zip(cols["id"], cols["t"]):
                words = word_hashes((text or "").encode("utf-8", "surrogatepass"))[0]
                at = _candidates(words, maps, size, gram, bits)
                if len(at):
                    held[0].append(window_hashes(words, size)[at])
                    held[1].append(np.full(len(at), key, dtype=np.int64))
                    held[2].append(at)
                    n += len(at)
                if n > FLUSH // 4:
                    yield firsts(*held)
                    held, n = ([], [], []), 0
            if n:
                yield firsts(*held)

    found = map_batches(picked.where("id is not null"), windows, "h long, d long, p int")
    first = found.groupBy("h").agg(F.min(F.struct("d", "p")).alias("f"))
    # starts of first occurrences as runs (start, length) packed per document
    firsts = written(first.groupBy("f.d").agg(F.sort_array(F.collect_list("f.p")).alias("p")).select("d", _runs(F.col("p")).alias("runs")), "firsts")

    def cut(batches):
        maps = [np.frombuffer(m, dtype=np.uint8) for m in shared.value]
        for cols in batches:
            n, gone, kept = [], [], []
            for key, text, runs in zip(cols["id"], cols["t"], cols["runs"]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                words, start, end = word_hashes(raw)
                drop = np.zeros(len(words), dtype=bool)
                if key is not None and len(words) >= size:
                    repeat = np.zeros(len(words) + 1, dtype=bool)
                    repeat[_candidates(words, maps, size, gram, bits)] = True
                    for r in runs or ():
                        repeat[r["s"] : r["e"] + 1] = False
                    at = np.flatnonzero(repeat)
                    if len(at):
                        step = np.zeros(len(words) + 1, dtype=np.int32)
                        step[at] += 1
                        step[at + size] -= 1
                        drop = np.cumsum(step[:-1]) > 0
                n.append(len(words))
                gone.append(int(drop.sum()))
                tokens = raw.split()  # bytes: white space is the six ASCII characters
                kept.append(b" ".join([w for w, x in zip(tokens, drop.tolist()) if not x] if gone[-1] else tokens).decode("utf-8", "surrogatepass"))
            yield {"doc_id": cols["id"], "n_words": n, "n_removed": gone, "kept": kept}

    joined = picked.join(small(firsts), picked["id"] == firsts["d"], "left").select("id", "t", "runs")
    return map_batches(joined, cut, "doc_id long, n_words long, n_removed long, kept string")


def _runs(p):
    """Sorted starts as an array of (s, e) runs of consecutive values."""
    edge = lambda step: F.filter(p, lambda x, i: (i == (0 if step < 0 else F.size(p) - 1)) | (F.get(p, i + step) != x + step))
    return F.arrays_zip(edge(-1).alias("s"), edge(1).alias("e"))


def _long(x):
    return pa.array(x.view(np.int64))


def _int(x):
    return pa.array(x.astype(np.int32))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
