"""BPE encoding and decoding with reuse of content-defined chunks (operator 6).

A rolling hash over the bytes cuts every text into chunks, at places that
depend on the content alone, so that passages shared by documents give the
same chunks wherever they stand.  One job counts the chunks over all
documents; a second encodes the shared ones that save most, each once, into a
dictionary of at most ``dictionary_mb`` that is broadcast.  (The bound is on a
cache: a chunk outside it is encoded where it stands, and kept by its task.)

A chunk's tokens are settled between its first and its last *safe* place: a
single space between two characters that are not white space, where the
vocabulary's pre-tokeniser always begins a new piece.  What is left at a join,
the end of one chunk and the start of the next, is encoded again as one string
between safe places; if a chunk has none, the string grows to the next chunk.
There both encodings agree by construction, so the tokens equal those of the
whole text.

Edge cases: a null text counts as empty and has no tokens; the special token's
string in a text is the special token, as the library has it; very long texts
are cut like others; ids and repeated rows are carried as they are; an empty
table gives an empty result."""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import lists, map_batches, written
from traitlab.llm.text import inverse, mix, powers

_U = np.uint64
_ROLL = 0xB5297A4D3F84D5B5 | 1
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_LAST = re.compile(r"(?s).*(?<=\S)( )(?=\S)")
#: the pre-tokeniser's pattern of byte-level BPE (fixed value of the format)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OUT_BYTES = 4_000_000


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple:
    """(encoder, special strings -> id, id -> bytes) of a byte-level BPE file
    of the tokenizers library; refuses files that need more than that."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, added = spec["pre_tokenizer"], spec["added_tokens"]
    if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec.get("post_processor") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or " " in a["content"] for a in added):
        raise ValueError(f"{path} has special tokens of another kind")
    # the format writes each byte as a printable character
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {a["content"]: a["id"] for a in added}
    known = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    order = [known[bytes(byte[c] for c in a + b)] for a, b in merges]
    if order != sorted(order):
        raise ValueError(f"{path}: token ids do not follow the merges")
    encoder = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
    return encoder, special, {i: t for t, i in known.items()} | {i: s.encode() for s, i in special.items()}


def cuts(raw: np.ndarray, mean_bytes: int = 512, window: int = 16) -> np.ndarray:
    """Chunk ends: places where the rolling hash of the last ``window`` bytes
    meets a mask and a character begins."""
    n = len(raw)
    if n <= window:
        return np.array([n])
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + _U(1)) * powers(_ROLL, n), out=sums[1:])
        h = mix((sums[window:] - sums[:-window]) * powers(inverse(_ROLL), n - window + 1))
    at = np.flatnonzero((h & _U(mean_bytes - 1)) == 0) + window
    at = at[at < n]
    at = at[(raw[at] & 0xC0) != 0x80]
    return np.append(at, n)


def chunk_texts(text: str) -> list[str]:
    data = text.encode("utf-8", "surrogatepass")
    ends = cuts(np.frombuffer(data, dtype=np.uint8)).tolist()
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]


def settle(encode, chunk: str) -> tuple[str, list[int], str] | None:
    """(head, settled tokens, tail) of a chunk; None without a safe place."""
    first = _SAFE.search(chunk)
    if first is None:
        return None
    a, b = first.start(), _LAST.match(chunk).start(1)
    return chunk[:a], encode(chunk[a:b]) if b > a else [], chunk[b:]


class Encoder:
    """Encodes whole texts chunk by chunk inside a task."""

    def __init__(self, path: str, shared: dict[str, tuple], keep: int = 4096):
        self.encoder, self.special, self.token = vocabulary(path)
        self.encode = self.encoder.encode_ordinary
        self.shared, self.own, self.keep = shared, OrderedDict(), keep
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def _settled(self, chunk: str):
        if (got := self.shared.get(chunk)) is not None:
            return got[0], np.frombuffer(got[1], dtype=np.int32).tolist(), got[2]
        if chunk in self.own:
            self.own.move_to_end(chunk)
            return self.own[chunk]
        got = self.own[chunk] = settle(self.encode, chunk)
        if len(self.own) > self.keep:
            self.own.popitem(last=False)
        return got

    def _plain(self, text: str) -> list[int]:
        ids, open_ = [], ""
        for chunk in chunk_texts(text):
            if (got := self._settled(chunk)) is None:
                open_ += chunk  # no safe place: the join grows to the next chunk
                continue
            head, settled, tail = got
            if open_ or head:
                ids += self.encode(open_ + head)
            ids += settled
            open_ = tail
        return ids + self.encode(open_) if open_ else ids

    def __call__(self, text: str) -> list[int]:
        if self.split is None or not any(s in text for s in self.special):
            return self._plain(text)
        return [i for part in self.split.split(text) if part for i in ([self.special[part]] if part in self.special else self._plain(part))]


def _hash(chunk: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(chunk.encode("utf-8", "surrogatepass")) - 2**63


def shared_chunks(docs: DataFrame, path: str, dictionary_mb: int = 8) -> dict[str, tuple]:
    """The chunks of two or more documents that save most, encoded once:
    chunk -> (head, tokens as 32-bit numbers, tail)."""
    spark = docs.sparkSession

    def count(batches):
        for cols in batches:
            seen: dict[int, list[int]] = {}
            for text in cols["t"]:
                for chunk in set(chunk_texts(text or "")):
                    if len(chunk) >= 32:
                        entry = seen.setdefault(_hash(chunk), [0, len(chunk)])
                        entry[0] += 1
            yield {"h": list(seen), "n": [x[0] for x in seen.values()], "size": [x[1] for x in seen.values()]}

    counted = map_batches(docs.select("t"), count, "h long, n long, size long").groupBy("h").agg(F.sum("n").alias("n"), F.max("size").alias("size")).where("n > 1")
    best = counted.orderBy(F.desc(F.expr("(n - 1) * size")), "h").limit(dictionary_mb * 2**20 // 2048).collect()
    if not best:
        return {}
    wanted = spark.sparkContext.broadcast(frozenset(r["h"] for r in best))

    def pick(batches):
        done = set()
        for cols in batches:
            found = {}
            for text in cols["t"]:
                for chunk in chunk_texts(text or ""):
                    if len(chunk) >= 32 and chunk not in found and (h := _hash(chunk)) in wanted.value and h not in done:
                        found[chunk] = h
                        done.add(h)
            yield {"h": list(found.values()), "chunk": list(found)}

    def settle_all(batches):
        encoder = vocabulary(path)[0]
        for cols in batches:
            got = [(c, settle(encoder.encode_ordinary, c)) for c in cols["chunk"]]
            got = [(c, s) for c, s in got if s]
            ids = [np.array(s[1], dtype=np.int32).tobytes() for _, s in got]
            yield {"chunk": [c for c, _ in got], "head": [s[0] for _, s in got], "ids": ids, "tail": [s[2] for _, s in got]}

    one = map_batches(docs.select("t"), pick, "h long, chunk string").groupBy("h").agg(F.min("chunk").alias("chunk"))
    rows = written(map_batches(one.select("chunk"), settle_all, "chunk string, head string, ids binary, tail string"), "chunks")
    return {r["chunk"]: (r["head"], bytes(r["ids"]), r["tail"]) for r in rows.toLocalIterator()}


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", dictionary_mb: int = 8) -> DataFrame:
    """(doc_id, ids, decoded) per row."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = picked.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(picked, path, dictionary_mb))

    def work(batches):
        encode = Encoder(path, shared.value)
        for cols in batches:
            out, size = {"doc_id": [], "ids": [], "decoded": []}, 0
            for key, text in zip(cols["id"], cols["t"]):
                ids = encode(text or "")
                out["doc_id"].append(key)
                out["ids"].append(np.array(ids, dtype=np.int32))
                out["decoded"].append(decode(ids, encode.token))
                size += len(text or "")
                if size > OUT_BYTES:
                    yield out | {"ids": _ints(out["ids"])}
                    out, size = {"doc_id": [], "ids": [], "decoded": []}, 0
            yield out | {"ids": _ints(out["ids"])}

    return map_batches(picked, work, f"doc_id {kind}, ids array<int>, decoded string")


def _ints(arrays):
    import pyarrow as pa

    return lists(arrays, pa.int32()) if arrays else []


def decode(ids: list[int], token: dict[int, bytes]) -> str:
    """Text of token ids; bytes that are no UTF-8 become U+FFFD, as the
    library has it.  Unknown ids are skipped."""
    return b"".join([token.get(i, b"") for i in ids]).decode("utf-8", "replace")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of stored token ids (null ids: empty text)."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def work(batches):
        token = vocabulary(path)[2]
        for cols in batches:
            yield {"doc_id": cols["doc_id"], "text": [decode(ids or [], token) for ids in cols["ids"]]}

    return map_batches(encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")), work, f"doc_id {kind}, text string")
