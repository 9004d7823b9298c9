"""Sequence packing along a space-filling curve (operator 11).

One pass encodes every whole text (byte-level BPE, then the end id 0), counts
its ids in hashed buckets, damps and normalises the counts and projects them
to a few dimensions; the cell of the projected point gives its place on a
Hilbert curve.  While a document holds a whole sequence it fills sequences of
its own, so no row ever carries more than one sequence's ids; what is left
goes on to the curve.  There the rests are range-sorted by Hilbert key (a group
of equal keys is split by a unique tie number) and laid end to end, so that
each sequence holds neighbours of the curve.  The last rests of a range are cut
at powers of two, which need no padding: no sequence is padded at all.

Numbers: sequence ids run from 0 without gaps; the offsets of the ranges come
from one count per task.

Edge cases: a null or empty text has the end id alone; ids, also null or
repeated ones, are carried as they are and each row is a document of its own;
very long texts are encoded in parts cut at single spaces between visible
characters, where the pre-tokeniser always begins a new piece, and leave the
task one sequence at a time; equal keys (copies) stand in the order of their
tie numbers; an empty table gives an empty result; other columns, whatever
their names, are not read."""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.bpe import vocabulary
from traitlab.llm.common import map_batches, table_offsets, written

_SAFE = re.compile(r"(?<=\S) (?=\S)")
PART = 1 << 19
BUCKETS, DIMS, BITS = 256, 4, 12
ROWS_OUT = 2048


def text_parts(text: str, size: int = PART):
    """A text cut into parts of about ``size`` characters that encode on their
    own; a stretch without a safe place stays whole."""
    at = 0
    while len(text) - at > size and (place := _SAFE.search(text, at + size)):
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


class Ids:
    """Encoder of whole texts into arrays of ids, the end id last."""

    def __init__(self, path: str):
        encoder, self.special, _ = vocabulary(path)
        self.encode = encoder.encode_ordinary
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def __call__(self, text: str):
        pieces = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
        for piece in pieces:
            if piece in self.special:
                yield np.array([self.special[piece]], dtype="<u4")
            elif piece:
                for part in text_parts(piece):
                    yield np.frombuffer(array("I", self.encode(part)), dtype=np.uint32).astype("<u4", copy=False)
        yield np.zeros(1, dtype="<u4")


@lru_cache(maxsize=2)
def _tables(seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of an id (by its low 16 bits), projection of buckets."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, BUCKETS, 1 << 16), rng.choice([-1.0, 1.0], 1 << 16), rng.normal(size=(BUCKETS, DIMS))


def cells(counts: np.ndarray) -> np.ndarray:
    """Grid cell (rows x DIMS, 0 to 2^BITS - 1) of hashed count vectors."""
    damped = np.sign(counts) * np.sqrt(np.abs(counts))
    norm = np.linalg.norm(damped, axis=1, keepdims=True)
    point = damped / np.where(norm > 0, norm, 1) @ _tables()[2]
    return np.minimum((1 << BITS) / (1 + np.exp(-1.702 * point)), (1 << BITS) - 1).astype(np.int64)


def hilbert(cell: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (rows x dims), vectorised:
    rotations are undone from the highest bit down, then the Gray code of the
    interleaved bits is undone."""
    x = cell.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            high = (x[d] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "local", "offset", "key", "tie", "ids")


def _cut(docs: DataFrame, path: str, kind: str, size: int) -> DataFrame:
    """Whole sequences of single documents as finished pieces (ids null), and
    the rest of each document with its ids and Hilbert key."""

    def work(batches):
        encode, (bucket, sign, _) = Ids(path), _tables()
        part, row, local = 2 * TaskContext.get().partitionId(), 0, 0
        for cols in batches:
            out: dict[str, list] = {f: [] for f in FIELDS}
            rests, counts = [], []
            for key, text in zip(cols["id"], cols["t"]):
                count, done, own, rest = np.zeros(BUCKETS), 0, [], np.empty(0, "<u4")
                for ids in encode(text or ""):
                    low = ids & 0xFFFF
                    count += np.bincount(bucket[low], weights=sign[low], minlength=BUCKETS)
                    rest = np.concatenate([rest, ids]) if len(rest) else ids
                    full = len(rest) // size * size
                    own += [(done + a, zlib.crc32(rest[a : a + size])) for a in range(0, full, size)]
                    done, rest = done + full, rest[full:]
                tokens = done + len(rest)
                for start, crc in own:
                    for f, v in zip(FIELDS, (key, start, size, crc, tokens, part, local, 0, None, None, None)):
                        out[f].append(v)
                    local += 1
                if len(rest):
                    rests.append((key, done, len(rest), None, tokens, None, None, None, None, (part << 40) + row, rest.tobytes()))
                    counts.append(count)
                row += 1
            places = hilbert(cells(np.array(counts))).tolist() if counts else []
            for values, place in zip(rests, places):
                for f, v in zip(FIELDS, values):
                    out[f].append(place if f == "key" else v)
            yield out

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, local long, offset long, key long, tie long, ids binary"
    return map_batches(docs, work, schema)


def powers_of_two(n: int) -> list[int]:
    """Falling powers of two that sum to ``n``."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _lay(rests: DataFrame, kind: str, size: int) -> DataFrame:
    """Sorted rests laid end to end within a task: pieces of its sequences."""

    def work(batches):
        part, local, held, fill = 2 * TaskContext.get().partitionId() + 1, 0, [], 0
        out: dict[str, list] = {f: [] for f in FIELDS[:8]}

        def close(pieces, number):
            at = 0
            for key, start, tokens, ids in pieces:
                for f, v in zip(FIELDS, (key, start, len(ids), zlib.crc32(ids), tokens, part, number, at)):
                    out[f].append(v)
                at += len(ids)

        for cols in batches:
            for key, start, tokens, raw in zip(cols["doc_id"], cols["start"], cols["doc_tokens"], cols["ids"]):
                ids = np.frombuffer(raw, dtype="<u4")
                while len(ids):
                    take = min(size - fill, len(ids))
                    held.append((key, start, tokens, ids[:take]))
                    start, ids, fill = start + take, ids[take:], fill + take
                    if fill == size:
                        close(held, local)
                        held, fill, local = [], 0, local + 1
            if len(out["doc_id"]) >= ROWS_OUT:
                yield out
                out = {f: [] for f in FIELDS[:8]}
        for room in powers_of_two(fill):
            pieces, fill = [], 0
            while fill < room:
                key, start, tokens, ids = held.pop(0)
                take = min(room - fill, len(ids))
                pieces.append((key, start, tokens, ids[:take]))
                fill += take
                if take < len(ids):
                    held.insert(0, (key, start + take, tokens, ids[take:]))
            close(pieces, local)
            local += 1
        yield out

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, local long, offset long"
    return map_batches(rests.select("doc_id", "start", "doc_tokens", "ids"), work, schema)


def pack(docs: DataFrame, path: str, size: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  ``size`` is a power of two."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = picked.schema["id"].dataType.simpleString()
    cut = written(_cut(picked, path, kind, size), "cut")
    along = cut.where("ids is not null").repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    laid = written(_lay(along, kind, size), "laid")
    pieces = cut.where("ids is null").select(laid.columns).unionByName(laid)
    numbered = pieces.join(F.broadcast(table_offsets(pieces, "part", F.max("local") + 1)), "part")
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("local")).alias("sequence_id"), "offset")
