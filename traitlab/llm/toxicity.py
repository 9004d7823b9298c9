"""Toxicity by Levenshtein automata over a learned lexicon (operator 10).

From a bounded labelled sample come a lexicon of words, and of word stems,
that stand in toxic documents and seldom elsewhere, each weighed by its log
odds.  The lexicon is a trie; the Levenshtein automata of all its words are
intersected with it on the fly, as one deterministic automaton whose states are
kept, so that a word is read once and either is an entry, begins with a stem,
or is a misspelling within the entry's edit bound (one edit from four letters,
two from nine).  A misspelling has its entry's log odds, halved by each edit;
near misses that clean training documents use at least as often as toxic ones
are ordinary words and left out.  Each hit is weighed by a window of words around
it: quotation marks about it and words of reporting speak for quotation, words
of address for abuse.  A logistic model of the weighed hits, fitted on the
other half of the sample than its lexicon, gives the score; the final lexicon
is learned from both halves.

Edge cases: a null or empty text has no hits and gets the score of a text
without hits; a null id is not held out; without training rows of both labels
every score is the share of label 1 (0.5 without any); repeated rows score
alike; an empty table gives an empty result."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import map_batches
from traitlab.llm.labelled import crc_mod, training_sample

MARKS = "\"'`.,;:!?()[]{}<>|*#$%&-_~/\\«»“”„‘’…¡¿"
QUOTES = frozenset("\"«»“”„")
#: words of reporting and of address in the languages of the corpus
REPORTING = frozenset("said says say wrote writes quoted quotes quote called term word title sagte schrieb zitat wort genannt dit écrit cité mot terme dijo escribió cita palabra término".split())
ADDRESS = frozenset("you your you're u ur du dich dir dein sie ihr tu te toi ton vous votre tú ti usted su".split())
WINDOW = 8
STEM = range(4, 9)
#: weight of a misspelling by edit
PER_EDIT = 0.5
#: hits
NONE, FUZZY, DIRECT = 0, 1, 2


class LexiconAutomaton:
    """Deterministic automaton of trie x Levenshtein; states made when met."""

    def __init__(self, words: Iterable[str], stems: Iterable[str], ordinary: frozenset = frozenset(), most_states: int = 50_000):
        self.child: list[dict[str, int]] = [{}]
        self.edits, self.whole, self.stem, self.entry = [0], [-1], [False], [""]
        for entries, stem in ((words, False), (stems, True)):
            for w in sorted(entries):
                k, at = 0 if stem else self.bound(w), 0
                for c in w:
                    if c not in self.child[at]:
                        self.child[at][c] = len(self.child)
                        self.child.append({})
                        self.edits.append(0)
                        self.whole.append(-1)
                        self.stem.append(False)
                        self.entry.append("")
                    self.edits[at] = max(self.edits[at], k)
                    at = self.child[at][c]
                self.edits[at] = max(self.edits[at], k)
                if stem:
                    self.stem[at] = True
                else:
                    self.whole[at], self.entry[at] = k, w
        self.ordinary, self.most = ordinary, most_states
        self._reset()

    @staticmethod
    def bound(word: str) -> int:
        return 0 if len(word) < 4 else 1 if len(word) < 9 else 2

    def _reset(self):
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, places: dict[int, int]) -> int:
        todo = list(places)  # letters of an entry that the word leaves out
        while todo:
            at = todo.pop()
            for nxt in self.child[at].values():
                e = places[at] + 1
                if e <= self.edits[nxt] and e < places.get(nxt, 99):
                    places[nxt] = e
                    todo.append(nxt)
        key = tuple(sorted(places.items()))
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        places: dict[int, int] = {}
        for at, e in self.sets[state]:
            nxt = self.child[at].get(c)
            if nxt is not None and e <= self.edits[nxt] and e < places.get(nxt, 99):
                places[nxt] = e
            if e < self.edits[at]:
                if e + 1 < places.get(at, 99):  # a letter too many
                    places[at] = e + 1
                for other in self.child[at].values():  # another letter
                    if e + 1 <= self.edits[other] and e + 1 < places.get(other, 99):
                        places[other] = e + 1
        if any(e == 0 and self.stem[at] for at, e in places.items()):
            return -2
        return self._state(places)

    def find(self, word: str) -> tuple[int, list[tuple[str, int]]]:
        """Kind of hit, and the (entry, edits) that a misspelling is near."""
        if len(self.sets) > self.most:
            self._reset()
        state = self.start
        for c in word:
            nxt = self.moves[state].get(c)
            if nxt is None:
                nxt = self.moves[state][c] = self._move(state, c)
            if nxt < 0:
                return DIRECT if nxt == -2 else NONE, []
            state = nxt
        near = [(self.entry[at], e) for at, e in self.sets[state] if e <= self.whole[at]]
        if any(e == 0 for _, e in near):
            return DIRECT, []
        return (FUZZY, near) if near and word not in self.ordinary else (NONE, [])

    def read(self, word: str) -> int:
        return self.find(word)[0]


@dataclass
class Lexicon:
    """Words and stems with their weights; near misses that are ordinary words."""

    words: dict[str, float]
    stems: dict[str, float]
    ordinary: frozenset = frozenset()


class Scanner:
    """Weighed hits of a text; verdicts on words are kept while there is room."""

    def __init__(self, lexicon: Lexicon, room: int = 300_000):
        self.lexicon = lexicon
        self.automaton = LexiconAutomaton(lexicon.words, lexicon.stems, lexicon.ordinary)
        self.room, self.known = room, {}

    def verdict(self, word: str) -> tuple[int, float] | None:
        """(kind, weight) of a hit."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > self.room:
            self.known.clear()
        bare, got = word.strip(MARKS), None
        kind, near = self.automaton.find(bare) if len(bare) > 2 else (NONE, [])
        if kind == DIRECT:
            got = kind, max(self.lexicon.words.get(bare, 0.0), *(self.lexicon.stems.get(bare[:n], 0.0) for n in STEM))
        elif kind == FUZZY:
            got = kind, max(self.lexicon.words[entry] * PER_EDIT**e for entry, e in near)
        self.known[word] = got
        return got

    def hits(self, text: str | None) -> list[tuple[str, int, float, float]]:
        """(word, kind, weight, context score from 0, quotation, to 1, abuse)."""
        words = (text or "").lower().split()
        found = {w: v for w in set(words) if (v := self.verdict(w))}
        return [(w.strip(MARKS), *found[w], context(words, i)) for i, w in enumerate(words) if w in found] if found else []

    def features(self, text: str | None) -> list[float]:
        top = direct = near = fuzzy = quoted = 0.0
        n = len((text or "").split())
        for _, kind, weight, score in self.hits(text):
            if kind == DIRECT:
                direct += weight * score
                top = max(top, weight * score)
            else:
                fuzzy += weight * score
                near = max(near, weight * score)
            quoted += 1 - score
        return [top, math.log1p(direct), math.log1p(100 * direct / max(n, 1)), near, math.log1p(fuzzy), math.log1p(100 * fuzzy / max(n, 1)), math.log1p(quoted), math.log1p(n) / 10]


def context(words: list[str], i: int) -> float:
    near = words[max(0, i - WINDOW) : i + WINDOW + 1]
    before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
    quoted = any(w[0] in QUOTES for w in before) and any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after)
    bare = [w.strip(MARKS) for w in near]
    score = 1.0 - 0.5 * quoted - 0.3 * any(w in REPORTING for w in bare) + 0.2 * any(w in ADDRESS for w in bare)
    return min(1.0, max(0.0, score))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic model, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep) + 1e-9 * np.eye(len(w)), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn_lexicon(sample: DataFrame, min_share: float, min_docs: int, purity: float, most: int) -> Lexicon:
    """Words and stems of toxic documents in the sample (t, y): in at least
    ``min_share`` of them and ``min_docs``, and toxic in a share ``purity`` of
    their documents (both classes weighed alike, counts taken on the safe side); a stem has at least twice the
    documents of any listed word it begins."""
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, {})

    def work(batches):
        count: dict[tuple[str, bool], list] = {}
        for cols in batches:
            for text, y in zip(cols["t"], cols["y"]):
                words = {w for w in (x.strip(MARKS) for x in set(text.lower().split())) if 2 < len(w) <= 40}
                for w in words:
                    count.setdefault((w, False), [0, 0])[y] += 1
                for s in {w[:n] for w in words for n in STEM if n < len(w)}:
                    count.setdefault((s, True), [0, 0])[y] += 1
        yield {"w": [k[0] for k in count], "stem": [k[1] for k in count], "clean": [v[0] for v in count.values()], "toxic": [v[1] for v in count.values()]}

    least = max(min_docs, math.ceil(min_share * toxic))
    counted = map_batches(sample.select("t", "y"), work, "w string, stem boolean, clean long, toxic long").groupBy("w", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sure = (F.col("toxic") - F.sqrt("toxic")) / toxic  # less a standard deviation
    share = sure / (sure + (F.col("clean") + 1) / clean)
    rows = counted.where((F.col("toxic") >= least) & (share >= purity)).orderBy(F.desc(share * F.col("toxic")), "w", "stem").limit(most).collect()
    weigh = lambda r: math.log((r["toxic"] + 0.5) / (toxic + 1)) - math.log((r["clean"] + 0.5) / (clean + 1))
    words = {r["w"]: r for r in rows if not r["stem"]}
    best: dict[str, int] = {}  # of the listed words that begin so
    for w, r in words.items():
        for n in STEM:
            best[w[:n]] = max(best.get(w[:n], 0), r["toxic"])
    stems = {r["w"]: weigh(r) for r in rows if r["stem"] and best.get(r["w"], 0) * 2 <= r["toxic"]}
    return Lexicon({w: weigh(r) for w, r in words.items()}, stems)


def with_ordinary(lexicon: Lexicon, sample: DataFrame, most: int) -> Lexicon:
    """The lexicon, knowing the near misses that the sample's clean texts use
    at least as often as its toxic ones: one row that quotes disables none."""
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def misspelt(batches):
        scan = Scanner(shared.value)
        seen: dict[str, list] = {}
        for cols in batches:
            for t, y in zip(cols["t"], cols["y"]):
                for w in {w for w in (x.strip(MARKS) for x in set(t.lower().split())) if (v := scan.verdict(w)) and v[0] == FUZZY}:
                    seen.setdefault(w, [0, 0])[y] += 1
        yield {"w": list(seen), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]}

    rows = map_batches(sample.select("t", "y"), misspelt, "w string, clean long, toxic long").groupBy("w").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rows = rows.where((F.col("clean") > 0) & (F.col("clean") * sizes.get(1, 0) >= F.col("toxic") * sizes.get(0, 0))).orderBy(F.desc("clean"), "w").limit(most).collect()
    return Lexicon(lexicon.words, lexicon.stems, frozenset(r["w"] for r in rows))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", fold: tuple[int, int] = (5, 0), per_class: int = 6000, min_share: float = 0.01, min_docs: int = 3, purity: float = 0.85, most_entries: int = 4000, id_col: str = "doc_id", text_col: str = "text"):
    """(lexicon, weights, prior) from at most about ``per_class`` labelled rows
    of either class whose crc32 modulo ``fold[0]`` is not ``fold[1]``; weights
    is None without rows of both classes."""
    sample, count = training_sample(docs, labels, label_col, crc_mod(F.col("id"), fold[0]) != fold[1], per_class, id_col, text_col)
    prior = count[1] / (count[0] + count[1]) if count[0] + count[1] else 0.5
    sample = sample.select("t", "y").dropDuplicates(["t", "y"])
    half = F.pmod(F.xxhash64("t", F.lit(7)), F.lit(2))
    options = (min_share, min_docs, purity, most_entries)
    first, second = sample.where(half == 0), sample.where(half == 1)
    lexicon = with_ordinary(learn_lexicon(first, *options), first, most_entries)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches):
        scan = Scanner(shared.value)
        for cols in batches:
            yield {"y": cols["y"], "x": [scan.features(t) for t in cols["t"]]}

    rows = sorted((r["y"], *r["x"]) for r in map_batches(second, measure, "y int, x array<double>").collect())
    if len({r[0] for r in rows}) < 2:
        return lexicon, None, prior
    x, y = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], dtype=float)
    weights = logistic(x, y)
    # the sample's classes are of other sizes than the labelled rows'
    weights[-1] += math.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) - math.log(y.mean() / (1 - y.mean()))
    return with_ordinary(learn_lexicon(sample, *options), sample, most_entries), weights, prior


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", fold: tuple[int, int] = (5, 0), id_col: str = "doc_id", text_col: str = "text", **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label_col, fold, id_col=id_col, text_col=text_col, **fitting))

    def work(batches):
        lexicon, weights, prior = model.value
        scan = Scanner(lexicon)
        for cols in batches:
            scores = []
            for t in cols["t"]:
                x = scan.features(t)
                scores.append(prior if weights is None else float(1 / (1 + np.exp(-np.clip(np.dot(weights, [*x, 1.0]), -30, 30)))))
            yield {"doc_id": cols["id"], "held_out": cols["held_out"], "score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    id_ = F.col(id_col).cast("long")
    picked = docs.select(id_.alias("id"), F.coalesce(crc_mod(id_, fold[0]) == fold[1], F.lit(False)).alias("held_out"), F.col(text_col).alias("t"))
    return map_batches(picked, work, "doc_id long, held_out boolean, score double, predicted int")
