"""Quality classifier by nearest-neighbour voting (operator 3).

A text's terms are its pairs of neighbouring characters (after folding bytes
into classes), the share of words that repeat the word before them, and the
share of words in eight-word windows that recur in the text.  On a
bounded labelled sample the weighted term matrix is factored (latent semantic
analysis), and the sample's unit vectors are broadcast with their labels.
Every document is projected the same way; its cosines with all labelled
vectors are computed exactly, block by block, and its ``k`` nearest labels
vote, weighted by similarity and by how many labelled rows each sampled one
stands for.

Edge cases: a null or empty text has no terms and gets the share of label 1
among the training rows; a null id is never held out of nothing: its
``held_out`` is false; without any training row every score is 0.5; repeated
rows score alike; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import map_batches
from traitlab.llm.labelled import crc_mod, training_sample
from traitlab.llm.text import covered, window_hashes, word_hashes


def _classes() -> np.ndarray:
    """Byte -> class: letters (either case one class each, capitals marked by
    a class of their own), digits, spaces, marks, other bytes."""
    out = np.full(256, 45, dtype=np.int64)
    out[0x80:0xC0] = 44
    for i in range(26):
        out[97 + i] = i
        out[65 + i] = 26
    out[48:58] = 27
    for i, group in enumerate((b" \t", b"\n\r", b".", b",", b"!?", b"|", b"#*$%&<>", b"\"'`", b"-_/", b":;", b"()[]{}")):
        out[list(group)] = 28 + i
    return out


_CLASS, N_CLASSES = _classes(), 46
N_TERMS = N_CLASSES * N_CLASSES + 2
#: weight of a share of repeats beside the logarithms of the other terms
REPEATS, WINDOW = 40.0, 8
#: words below which a repeat is weighed as in a text of so many
FEW = 100


def term_rates(text: str | None) -> np.ndarray:
    """log(1 + occurrences per 1000 bytes) of every pair, and the weighed
    shares of repeats."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_TERMS, dtype=np.float32)
    if len(raw) > 1:
        c = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
        out[:-2] = np.log1p(np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_TERMS - 2) * (1000 / len(raw)))
        words = word_hashes(raw)[0]
        if len(words) > 1:
            out[-2] = REPEATS * (words[1:] == words[:-1]).sum() / max(len(words), FEW)
        windows = window_hashes(words, WINDOW)
        if len(windows) > 1:
            _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
            out[-1] = REPEATS * covered(np.flatnonzero(count[where] > 1), WINDOW, len(words)).sum() / max(len(words), FEW)
    return out


def leading_directions(x: np.ndarray, dims: int, extra: int = 16, turns: int = 4) -> np.ndarray:
    """The right singular vectors of the ``dims`` largest singular values, by
    subspace iteration from a fixed random start."""
    dims = min(dims, *x.shape)
    q = np.random.default_rng(3).standard_normal((x.shape[1], min(dims + extra, x.shape[1]))).astype(np.float32)
    for _ in range(turns):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    return q @ np.linalg.svd(x @ q, full_matrices=False)[2][:dims].T


class Voter:
    """Projection, labelled vectors and votes."""

    def __init__(self, terms: np.ndarray, y: np.ndarray, weight: np.ndarray, dims: int, k: int):
        n = len(terms)
        self.idf = (np.log((1 + n) / (1 + (terms > 0).sum(axis=0))) + 1).astype(np.float32)
        x = self._scaled(terms)
        self.basis = leading_directions(x, dims)
        self.known, self.y, self.weight, self.k = self._unit(x @ self.basis), y.astype(np.float32), weight.astype(np.float32), min(k, n)
        self.prior = float((y * weight).sum() / weight.sum())

    def _scaled(self, terms):
        return self._unit(terms * self.idf)

    @staticmethod
    def _unit(x):
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def score(self, terms: np.ndarray) -> np.ndarray:
        x = self._unit(self._scaled(terms) @ self.basis)
        out = np.full(len(x), self.prior)
        live = np.flatnonzero(np.abs(terms).sum(axis=1) > 0)
        for at in np.array_split(live, max(1, -(-len(live) // 512))):
            if not len(at):
                continue
            cos = x[at] @ self.known.T
            near = np.argpartition(cos, -self.k, axis=1)[:, -self.k :]
            sim = np.take_along_axis(cos, near, axis=1)
            w = np.maximum(sim, 1e-6) ** 8 * self.weight[near]
            out[at] = (w * self.y[near]).sum(axis=1) / w.sum(axis=1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fold: tuple[int, int] = (3, 1), per_class: int = 2000, dims: int = 48, k: int = 25, id_col: str = "doc_id", text_col: str = "text") -> Voter | None:
    """Fit on at most about ``per_class`` rows of either label whose crc32
    modulo ``fold[0]`` is not ``fold[1]``."""
    sample, count = training_sample(docs, labels, label_col, crc_mod(F.col("id"), fold[0]) != fold[1], per_class, id_col, text_col)

    def work(batches):
        for cols in batches:
            yield {"id": cols["id"], "y": cols["y"], "terms": [term_rates(t).astype(np.float16).tobytes() for t in cols["t"]]}

    rows = sorted(map_batches(sample, work, "id long, y int, terms binary").collect(), key=lambda r: (r["id"], r["terms"]))
    if not rows:
        return None
    y = np.array([r["y"] for r in rows])
    terms = np.stack([np.frombuffer(r["terms"], dtype=np.float16) for r in rows]).astype(np.float32)
    weight = np.array([count[v] / max(1, (y == v).sum()) for v in y.tolist()])
    return Voter(terms, y, weight, dims, k)


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fold: tuple[int, int] = (3, 1), id_col: str = "doc_id", text_col: str = "text", **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label_col, fold, id_col=id_col, text_col=text_col, **fitting))

    def work(batches):
        voter = shared.value
        for cols in batches:
            scores = []
            for lo in range(0, len(cols["t"]), 512):
                texts = cols["t"][lo : lo + 512]
                scores += [0.5] * len(texts) if voter is None else voter.score(np.stack([term_rates(t) for t in texts])).tolist()
            yield {"doc_id": cols["id"], "held_out": cols["held_out"], "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    id_ = F.col(id_col).cast("long")
    picked = docs.select(id_.alias("id"), F.coalesce(crc_mod(id_, fold[0]) == fold[1], F.lit(False)).alias("held_out"), F.col(text_col).alias("t"))
    return map_batches(picked, work, "doc_id long, held_out boolean, score double, predicted int")
