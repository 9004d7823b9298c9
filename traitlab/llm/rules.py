"""Quality rules as a short-circuit cascade (operator 4).

Each rule says whether a document is rejected.  On a bounded sample every rule
runs on every document and its mean cost (seconds) and rejection rate are
measured; the rules are then ordered by rejection per cost, and over the whole
table a document leaves the cascade at its first rejection.  The verdict is
the same in every order; only the work differs.

Edge cases: a null or empty text has no words and fails the base rule; ids and
all other columns are carried as they are; repeated rows are judged alike; an
empty table gives an empty result."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import map_batches
from traitlab.llm.text import SPACE, covered, window_hashes, word_hashes

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LOWER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_UPPER[65:91], _LOWER[97:123] = True, True

REPEAT_WINDOW = 8


@dataclass
class Doc:
    """One text; what rules share is computed when first asked for."""

    text: str
    raw: np.ndarray = field(init=False)
    words: np.ndarray = field(init=False)

    def __post_init__(self):
        data = self.text.encode("utf-8", "surrogatepass")
        self.raw = np.frombuffer(data, dtype=np.uint8)
        self.words, self.start, self.end = word_hashes(data)

    @property
    def n_words(self) -> int:
        return len(self.words)

    def word_chars(self) -> int:
        return int((~SPACE[self.raw] & ((self.raw & 0xC0) != 0x80)).sum())

    def n_symbols(self) -> int:
        return int(_SYMBOL[self.raw].sum())

    def lines(self) -> tuple[int, int]:
        """Lines with a word, and those equal to an earlier one."""
        with_word = [x for x in self.text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        return len(with_word), len(with_word) - len(set(with_word))

    def n_repeat_words(self) -> int:
        seen = window_hashes(self.words, REPEAT_WINDOW)
        if not len(seen):
            return 0
        _, where, count = np.unique(seen, return_inverse=True, return_counts=True)
        return int(covered(np.flatnonzero(count[where] > 1), REPEAT_WINDOW, self.n_words).sum())


@dataclass(frozen=True)
class Rule:
    """``rejects(doc, base)``; ``base`` holds the figures computed before."""

    name: str
    rejects: Callable[[Doc, dict], bool]


def _shouting(doc: Doc, base: dict) -> bool:
    upper = int(_UPPER[doc.raw].sum())
    return 10 * upper > 6 * (upper + int(_LOWER[doc.raw].sum()))


def _one_word(doc: Doc, base: dict) -> bool:
    """The most frequent word makes up over a quarter of all words."""
    return doc.n_words > 0 and 4 * int(np.unique(doc.words, return_counts=True)[1].max()) > doc.n_words


RULES = (
    Rule("symbols", lambda d, b: 10 * b["n_symbols"] > 3 * b["n_words"]),
    Rule("duplicate_lines", lambda d, b: 2 * b["n_dup_lines"] > b["n_lines"]),
    Rule("short_words", lambda d, b: b["word_chars"] < 2 * b["n_words"]),
    Rule("long_words", lambda d, b: b["word_chars"] > 25 * b["n_words"]),
    Rule("shouting", _shouting),
    Rule("exclamations", lambda d, b: 2 * int((d.raw == 33).sum()) > b["n_words"]),
    Rule("one_word", _one_word),
    Rule("stutter", lambda d, b: 10 * int((d.words[1:] == d.words[:-1]).sum()) > 3 * b["n_words"]),
)


def base_figures(doc: Doc) -> dict:
    n_lines, n_dup = doc.lines()
    b = {"n_words": doc.n_words, "word_chars": doc.word_chars(), "n_symbols": doc.n_symbols(), "n_dup_lines": n_dup, "n_lines": n_lines, "n_repeat_words": doc.n_repeat_words()}
    b["base_failed"] = b["n_words"] < 20 or 100 * b["n_repeat_words"] > 30 * b["n_words"]
    return b


def measure(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[tuple[str, float, float]]:
    """(name, seconds per document, share rejected) of each rule, on a sample
    of about ``sample_rows`` rows (rows drawn by a hash of the text)."""
    n = docs.count()
    part = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    if n > sample_rows:
        part = part.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample_rows / n) + 1))

    def work(batches):
        for cols in batches:
            docs_ = [Doc(t) for t in cols["t"]]
            base = [base_figures(d) for d in docs_]
            live = [(d, b) for d, b in zip(docs_, base) if not b["base_failed"]]
            out = {"rule": [], "s": [], "hits": [], "n": []}
            for rule in rules:
                began = time.perf_counter()
                hits = sum(bool(rule.rejects(d, b)) for d, b in live)
                out["rule"].append(rule.name)
                out["s"].append(time.perf_counter() - began)
                out["hits"].append(hits)
                out["n"].append(len(live))
            yield out

    got = map_batches(part, work, "rule string, s double, hits long, n long").groupBy("rule").agg(F.sum("s").alias("s"), F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    by = {r["rule"]: r for r in got}
    return [(r.name, by[r.name]["s"] / max(1, by[r.name]["n"]), by[r.name]["hits"] / max(1, by[r.name]["n"])) if r.name in by else (r.name, 0.0, 0.0) for r in rules]


def cascade_order(measured: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejection per cost, highest first (ties by name)."""
    return [name for name, _, _ in sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[0]))]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """One row per document: the base figures, ``base_failed``, ``kept``, and
    ``rejected_by`` (the first rule that fired; null if none).  One scan."""
    order = cascade_order(measure(docs, text_col, rules, sample_rows))
    ordered = sorted(rules, key=lambda r: order.index(r.name))
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        for cols in batches:
            out = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")}
            for t in cols["t"]:
                doc = Doc(t or "")
                b = base_figures(doc)
                b["rejected_by"] = "base" if b["base_failed"] else next((r.name for r in ordered if r.rejects(doc, b)), None)
                b["kept"] = b["rejected_by"] is None
                for k in out:
                    out[k].append(b[k])
            yield {"doc_id": cols["doc_id"], **out}

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    return map_batches(picked, work, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the cascade, with all
    columns, filtered where they are read (no shuffle, no join)."""
    order = cascade_order(measure(docs, text_col, rules, sample_rows))
    ordered = sorted(rules, key=lambda r: order.index(r.name))
    at = docs.columns.index(text_col)

    def good(text: str | None) -> bool:
        doc = Doc(text or "")
        b = base_figures(doc)
        return not b["base_failed"] and not any(r.rejects(doc, b) for r in ordered)

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([good(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
