"""Random forests with exact thresholds (L5, L6), grown by Spark jobs.

A round finds the best split of every open node of every tree in one pass.
Each task routes its rows through the trees grown so far (these, the classes'
totals and the feature choice of the open nodes travel as a broadcast; no node
id is stored) and emits, per open node, feature, value and class, the summed
weight: ``x <= value`` is a candidate for every value that occurs.  These cells
are range-sorted by (node, feature, value).  A task adds up the classes along
each (node, feature) run and keeps the run's best candidate, so no run has to
lie in one task: the run that opens a task's range may go on from the range
before, so its cells are kept with their sums, and are judged when the total of
the ranges before is known (one row per task on the driver).

The driver holds the trees.  Without ``max_leaf_nodes`` a round splits every
node that may be split.  With it, the leaf of the greatest impurity decrease is
split first; a round also evaluates the children of all leaves that could
still be reached with the leaves left, so that rounds follow the depth of the
tree and not its leaves.

Equal scores (to 1e-10) go to the lowest feature, then the lowest value.  With
``bootstrap`` a row counts Poisson(1) times in a tree, drawn by a hash of its
key, the tree and the seed: a lost task draws the same again.
``min_samples_*`` count rows drawn at least once, like the reference's
estimator.  Rows with a null label train nothing; null or NaN features are
refused."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.operators.sample import MAX_GROUPS, collect_bounded
from traitlab.session import scratch_table

#: nodes of all trees that the driver holds
MAX_NODES = 2_000_000
#: scores are compared at this many digits
DIGITS = 10
#: cumulated Poisson(1) probabilities of 0, 1, 2, ...
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def hashed(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finaliser of ``x`` and a salt."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def draws(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Times each row counts in a tree: Poisson(1) by hash."""
    uniform = (hashed(rid, seed * 1_000_003 + tree) >> np.uint64(11)) / 2.0**53
    return np.searchsorted(_POISSON, uniform, side="right")


class Tree:
    """Node arrays; feature -1 marks a leaf."""

    def __init__(self, totals: np.ndarray, count: int):
        self.feature, self.threshold, self.left, self.right = [-1], [0.0], [-1], [-1]
        self.totals, self.count, self.depth = [totals], [count], [0]
        #: per node: None not yet evaluated, False no split, else (gain, feature, value, left totals, left count)
        self.split: list = [None]

    def divide(self, node: int) -> None:
        _, feature, value, totals, count = self.split[node]
        self.feature[node], self.threshold[node] = feature, value
        for side, t, m in (("left", totals, count), ("right", self.totals[node] - totals, self.count[node] - count)):
            getattr(self, side)[node] = len(self.feature)
            for held, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.totals, t), (self.count, m), (self.depth, self.depth[node] + 1), (self.split, None)):
                held.append(v)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)

    def state(self) -> dict:
        """What prediction needs, as plain lists."""
        return {"feature": [int(f) for f in self.feature], "threshold": [float(v) for v in self.threshold], "left": self.left, "right": self.right, "totals": [t.tolist() for t in self.totals]}

    @classmethod
    def restored(cls, state: dict) -> Tree:
        out = cls(np.array(state["totals"][0]), 0)
        for name in ("feature", "threshold", "left", "right"):
            setattr(out, name, state[name])
        out.totals = [np.array(t) for t in state["totals"]]
        return out


@dataclass
class PackedTree:
    """A finished tree in a few bytes: the nodes that its root reaches, the
    shares of the leaves' classes."""

    data: bytes

    @classmethod
    def of(cls, tree: Tree) -> PackedTree:
        feature, threshold, left, right = tree.arrays()
        at, order = np.array([0]), []
        while len(at):
            order.append(at)
            inner = at[feature[at] >= 0]
            at = np.column_stack([left[inner], right[inner]]).ravel()
        order = np.concatenate(order)
        place = np.full(len(feature), -1)
        place[order] = np.arange(len(order))
        leaf = feature[order] < 0
        totals = np.array([tree.totals[n] for n in order[leaf]])
        share = totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-300)
        held = (feature[order].astype(np.int32), threshold[order], np.where(leaf, -1, place[left[order]]).astype(np.int32), share)
        return cls(zlib.compress(pickle.dumps(held, protocol=5), 1))

    def __iter__(self):
        """The arrays to route rows by, the class shares by node."""
        feature, threshold, left, share = pickle.loads(zlib.decompress(self.data))
        every = np.zeros((len(feature), share.shape[1]))
        every[feature < 0] = share
        yield feature, threshold, left, np.where(left < 0, -1, left + 1)
        yield every

    def state(self) -> dict:
        """As ``Tree.state``; the shares in place of the totals."""
        (feature, threshold, left, right), share = self
        return {"feature": feature.tolist(), "threshold": threshold.tolist(), "left": left.tolist(), "right": right.tolist(), "totals": share.tolist()}


def route(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Node of every row."""
    feature, threshold, left, right = tree
    node = np.zeros(len(x), dtype=np.int64)
    inner = np.flatnonzero(feature[node] >= 0)
    while len(inner):
        at = node[inner]
        low = x[inner, feature[at]] <= threshold[at]
        node[inner] = np.where(low, left[at], right[at])
        inner = inner[feature[node[inner]] >= 0]
    return node


def gini(totals: np.ndarray) -> float:
    n = totals.sum()
    return 1.0 - float(np.square(totals / n).sum()) if n else 0.0


def split_scores(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weighted Gini impurity of the halves, as a share of the node's weight;
    infinite where a half is empty."""
    right = total - left
    nl, nr = left.sum(axis=1), right.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        held = np.square(left).sum(axis=1) / nl + np.square(right).sum(axis=1) / nr
        score = 1.0 - held / (nl + nr)
    return np.where((nl > 0) & (nr > 0) & np.isfinite(score), np.round(score, DIGITS), np.inf)


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _col(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


_CELLS = "run long, v double, c int, w double, m long"
_FOUND = "kind int, part long, run long, score double, v double, totals array<double>, m long"


def _cells(data: DataFrame, shared, p: int, classes: int, seed: int, bootstrap: bool) -> DataFrame:
    """Cells of the open nodes: run = node slot * features + feature."""

    def work(batches):
        trees, slots, chosen = (shared.value[k] for k in ("trees", "slots", "chosen"))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, w, rid = _matrix(batch, "x", p), _col(batch, "y"), _col(batch, "w"), _col(batch, "rid")
            # the different values of all features, numbered through
            parts = [np.unique(x[:, f], return_inverse=True) for f in range(p)]
            begin = np.cumsum([0, *(len(u) for u, _ in parts)])
            value, feature = np.concatenate([u for u, _ in parts]), np.repeat(np.arange(p), np.diff(begin))
            code = np.column_stack([back + at for (_, back), at in zip(parts, begin)])
            for t, tree in trees.items():
                slot = slots[t][route(tree, x)]
                times = draws(rid, t, seed) if bootstrap else np.ones(len(x), dtype=np.int64)
                rows = np.flatnonzero((slot >= 0) & (times > 0))
                use = chosen[slot[rows]]
                if not use.any():
                    continue
                full = ((slot[rows, None] * len(value) + code[rows]) * classes + y[rows, None])[use]
                weight = np.broadcast_to((w[rows] * times[rows])[:, None], use.shape)[use]
                key, back = np.unique(full, return_inverse=True)
                place = key // classes
                at = place % len(value)
                run = place // len(value) * p + feature[at]
                yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(value[at]), pa.array((key % classes).astype(np.int32)), pa.array(np.bincount(back, weight)), pa.array(np.bincount(back))], names=["run", "v", "c", "w", "m"])

    return data.mapInArrow(work, _CELLS)


def _scan(cells: DataFrame, shared, p: int, classes: int) -> DataFrame:
    """kind 0: best candidate of a run; 1: candidates of the run that opens a
    range, with sums inside the range; 2 and 3: totals of the first and last
    run of a range."""

    def work(batches):
        totals, counts, least = (shared.value[k] for k in ("totals", "counts", "least"))
        part = TaskContext.get().partitionId()
        rest, now, first = None, None, True  # cells of the open (run, value); sums of the open run; is it the range's first

        def close(out):
            run, left, m, best = now
            if first:
                out.append((2, run, None, None, left.tolist(), m))
            if best is not None:
                out.append((0, run, *best))

        def table(rows):
            kind, run, score, v, left, m = zip(*rows) if rows else ([],) * 6
            arrays = [pa.array(kind, pa.int32()), pa.array([part] * len(kind), pa.int64()), pa.array(run, pa.int64()), pa.array(score, pa.float64()), pa.array(v, pa.float64()), pa.array(left, pa.list_(pa.float64())), pa.array(m, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "part", "run", "score", "v", "totals", "m"])

        def take(run, v, c, w, m, out):
            """Whole (run, value) groups, sorted; all runs at once."""
            nonlocal now, first
            one = np.zeros((len(run), classes))
            one[np.arange(len(run)), c] = w
            last = np.flatnonzero(np.r_[(run[1:] != run[:-1]) | (v[1:] != v[:-1]), True])
            sums, seen = one.cumsum(axis=0)[last], m.cumsum()[last]
            run, v = run[last], v[last]
            begin = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            length = np.diff(np.r_[begin, len(run)])
            base, gone, kept = np.vstack([np.zeros(classes), sums])[begin], np.r_[0, seen][begin], None
            if now is not None and now[0] == run[0]:
                base[0] -= now[1]
                gone[0] -= now[2]
                kept = now[3]
            elif now is not None:
                close(out)
                first = False
            left, cnt = sums - np.repeat(base, length, axis=0), seen - np.repeat(gone, length)
            slot = run // p
            score = split_scores(left, totals[slot])
            score[(cnt < least) | (counts[slot] - cnt < least)] = np.inf
            if first and part:  # judged later
                n = length[0]
                out += zip([1] * n, run[:n].tolist(), [None] * n, v[:n].tolist(), left[:n].tolist(), cnt[:n].tolist())
                score[:n] = np.inf
            low = np.minimum.reduceat(score, begin)
            hits = np.flatnonzero(score == np.repeat(low, length))
            best = hits[np.unique(np.repeat(np.arange(len(begin)), length)[hits], return_index=True)[1]]
            ends = begin + length - 1
            found = [(float(score[i]), float(v[i]), left[i].tolist(), int(cnt[i])) if np.isfinite(score[i]) else None for i in best]
            if kept is not None and (found[0] is None or kept[0] <= found[0][0]):
                found[0] = kept
            for i, e in enumerate(ends):
                now = (int(run[e]), left[e], int(cnt[e]), found[i])
                if i + 1 < len(ends):
                    close(out)
                    first = False

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [_col(batch, n) for n in ("run", "v", "c", "w", "m")]
            if rest is not None:
                cols = [np.concatenate(z) for z in zip(rest, cols)]
            run, v = cols[:2]
            whole = int(np.flatnonzero((run != run[-1]) | (v != v[-1]))[-1]) + 1 if (run[0], v[0]) != (run[-1], v[-1]) else 0
            rest = [z[whole:] for z in cols]
            out: list = []
            if whole:
                take(*[z[:whole] for z in cols], out)
            yield table(out)
        out = []
        if rest is not None:
            take(*rest, out)
            close(out)
            out.append((3, now[0], None, None, now[1].tolist(), now[2]))
        yield table(out)

    return cells.repartitionByRange("run", "v").sortWithinPartitions("run", "v").mapInArrow(work, _FOUND)


def _late(found: DataFrame, shared, p: int, before: dict) -> DataFrame:
    """The candidates of runs that open a range, judged with the totals of the
    ranges before."""

    def work(batches):
        totals, counts, least = (shared.value[k] for k in ("totals", "counts", "least"))
        width = totals.shape[1]
        for batch in batches:
            rows: dict[int, tuple] = {}
            if batch.num_rows:
                part, run, v, left, m = _col(batch, "part"), _col(batch, "run"), _col(batch, "v"), _matrix(batch, "totals", width), _col(batch, "m")
                for g in np.unique(part):
                    at = part == g
                    key = int(run[at][0])
                    add, more = before.get(int(g), (np.zeros(width), 0))
                    sums, cnt = left[at] + add, m[at] + more
                    score = split_scores(sums, totals[key // p])
                    score[(cnt < least) | (counts[key // p] - cnt < least)] = np.inf
                    order = np.lexsort((v[at], score))
                    i = order[0]
                    if np.isfinite(score[i]):
                        rows[int(g)] = (key, float(score[i]), float(v[at][i]), sums[i].tolist(), int(cnt[i]))
            key, score, v, sums, cnt = zip(*rows.values()) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(score, pa.float64()), pa.array(v, pa.float64()), pa.array(sums, pa.list_(pa.float64())), pa.array(cnt, pa.int64())], names=["run", "score", "v", "totals", "m"])

    return found.where("kind = 1").mapInArrow(work, "run long, score double, v double, totals array<double>, m long")


def _totals_before(ends: list) -> dict:
    """part -> (class totals, rows) of its first run in the ranges before."""
    parts: dict[int, dict] = {}
    for r in ends:
        parts.setdefault(r["part"], {})[r["kind"]] = (r["run"], np.array(r["totals"]), r["m"])
    out, open_run, held = {}, None, None
    for part in sorted(parts):
        first, last = parts[part][2], parts[part][3]
        if first[0] == open_run:
            out[part] = held
        held = (last[1] + held[0], last[2] + held[1]) if first[0] == open_run == last[0] else last[1:]
        open_run = last[0]
    return out


def best_splits(data: DataFrame, trees: list[Tree], nodes: list[tuple[int, int]], chosen: np.ndarray, p: int, classes: int, least: int, seed: int, bootstrap: bool) -> dict:
    """(tree, node) -> (score, feature, value, left totals, left rows) for the
    given open nodes; nodes without a valid split are left out."""
    slots = {}
    for i, (t, node) in enumerate(nodes):
        slots.setdefault(t, np.full(len(trees[t].feature), -1, dtype=np.int64))[node] = i
    shared = data.sparkSession.sparkContext.broadcast(
        {
            "trees": {t: trees[t].arrays() for t in slots},
            "slots": slots,
            "chosen": chosen,
            "totals": np.array([trees[t].totals[n] for t, n in nodes]),
            "counts": np.array([trees[t].count[n] for t, n in nodes]),
            "least": least,
        }
    )
    found = scratch_table(_scan(_cells(data, shared, p, classes, seed, bootstrap), shared, p, classes), "forest")
    before = _totals_before(found.where("kind > 1").select("kind", "part", "run", "totals", "m").collect())
    cols = ["run", "score", "v", "totals", "m"]
    every = found.where("kind = 0").select(*cols).unionByName(_late(found, shared, p, before))
    slot = F.floor(F.col("run") / p).alias("slot")
    best = every.groupBy(slot).agg(F.min(F.struct("score", "run", "v", "totals", "m")).alias("b")).select("slot", "b.*").collect()
    shared.unpersist()
    return {nodes[r["slot"]]: (r["score"], int(r["run"] % p), r["v"], np.array(r["totals"]), int(r["m"])) for r in best}


@dataclass
class ExactForest:
    cols: list[str]
    classes: list
    trees: list[Tree | PackedTree]  # packed ones vote by probability
    vote: str = "probability"
    label_type: object = None
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "p", prob_prefix: str | None = "prob_") -> DataFrame:
        """Prediction per row: the class with the most votes of the trees, or
        with the greatest mean share in the leaves; the first class on ties."""
        shared = df.sparkSession.sparkContext.broadcast([t if isinstance(t, PackedTree) else (t.arrays(), self._leaves(t)) for t in self.trees])
        cols, k = self.cols, len(self.classes)
        schema = T.StructType([*df.schema.fields, T.StructField("_share", T.ArrayType(T.DoubleType()))])

        def work(batches):
            for batch in batches:
                x = np.column_stack([_col(batch, c).astype(float) for c in cols]) if batch.num_rows else np.empty((0, len(cols)))
                share = np.zeros((len(x), k))
                for arrays, leaf in shared.value:
                    share += leaf[route(arrays, x)]
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array((share / len(shared.value)).ravel()))], names=[*batch.schema.names, "_share"])

        scored = df.mapInArrow(work, schema)
        labels = F.array(*[F.lit(c) for c in self.classes])
        scored = scored.withColumn(out, F.element_at(labels, F.array_position("_share", F.array_max("_share")).cast("int")))
        if prob_prefix:
            scored = scored.withColumns({f"{prob_prefix}{c}": F.col("_share")[i] for i, c in enumerate(self.classes)})
        return scored.drop("_share")

    def _leaves(self, tree: Tree) -> np.ndarray:
        """Per node: a vote for its most frequent class, or class shares."""
        totals = np.array(tree.totals)
        if self.vote == "majority":
            return np.eye(totals.shape[1])[totals.argmax(axis=1)]
        return totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-300)


def features_per_node(value, p: int) -> int:
    """Features a node may choose from: a count, a share, 'sqrt', 'log2', or
    all (None)."""
    if value is None or value == "all":
        return p
    if value in ("sqrt", "auto"):
        return max(1, int(np.sqrt(p)))
    if value == "log2":
        return max(1, int(np.log2(p)))
    return min(p, value) if isinstance(value, int) else max(1, int(value * p))


def grow_forest(
    train: DataFrame,
    cols: Sequence[str],
    y: str,
    key: str | None = None,
    n_estimators: int = 100,
    max_depth: int | None = None,
    max_features=None,
    min_samples_leaf: int = 1,
    min_samples_split: int = 2,
    max_leaf_nodes: int | None = None,
    bootstrap: bool = True,
    weight: str | None = None,
    vote: str = "probability",
    seed: int = 42,
) -> ExactForest:
    """Forest over ``cols``; ``key`` identifies rows for the draws (else their
    place in the written training table does)."""
    cols, p = list(cols), len(cols)
    train = train.where(F.col(y).isNotNull())
    classes = [r[0] for r in collect_bounded(train.select(y).distinct().orderBy(y), MAX_GROUPS, "classes")]
    if not classes:
        raise ValueError("no labelled rows")
    labels = F.array(*[F.lit(c) for c in classes])
    rid = F.xxhash64(key) if key else F.monotonically_increasing_id()
    x = F.array(*[F.col(c).cast("double") for c in cols])
    data = scratch_table(train.select(x.alias("x"), (F.array_position(labels, F.col(y)) - 1).cast("int").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"), rid.alias("rid")), "forest-train")
    if data.where(F.exists("x", lambda v: v.isNull() | F.isnan(v))).limit(1).count():
        raise ValueError("null or NaN features")
    trees = _roots(data, len(classes), n_estimators, seed, bootstrap)
    subset = features_per_node(max_features, p)

    def may_split(tree: Tree, node: int) -> bool:
        return tree.count[node] >= max(min_samples_split, 2) and (max_depth is None or tree.depth[node] < max_depth) and np.count_nonzero(tree.totals[node]) > 1

    while True:
        nodes = []
        for t, tree in enumerate(trees):
            for node in range(len(tree.split)):
                if tree.split[node] is None:
                    if may_split(tree, node):
                        nodes.append((t, node))
                    else:
                        tree.split[node] = False
        if nodes:
            chosen = np.ones((len(nodes), p), dtype=bool)
            if subset < p:
                for i, (t, node) in enumerate(nodes):
                    chosen[i] = np.isin(np.arange(p), np.random.default_rng([seed, t, node]).choice(p, subset, replace=False))
            found = best_splits(data, trees, nodes, chosen, p, len(classes), min_samples_leaf, seed, bootstrap)
            for t, node in nodes:
                tree, got = trees[t], found.get((t, node))
                gain = tree.totals[node].sum() * (gini(tree.totals[node]) - got[0]) if got else 0.0
                tree.split[node] = (gain, *got[1:]) if got else False
        grown = False
        for tree in trees:
            for node in _to_divide(tree, max_leaf_nodes):
                tree.divide(node)
                grown = True
        if sum(len(t.feature) for t in trees) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: bound max_depth or max_leaf_nodes")
        if not grown:
            break
    if max_leaf_nodes is not None:
        for tree in trees:
            keep = set(_best_first(tree, max_leaf_nodes)[0])
            for node in range(len(tree.feature)):
                if node not in keep:
                    tree.feature[node] = -1
    return ExactForest(cols, classes, trees, vote, train.schema[y].dataType)


def _roots(data: DataFrame, classes: int, n: int, seed: int, bootstrap: bool) -> list[Tree]:
    """Trees of one node: class totals and drawn rows, one small job."""

    def work(batches):
        total = np.zeros((n, classes + 1))
        for batch in batches:
            y, w, rid = _col(batch, "y"), _col(batch, "w"), _col(batch, "rid")
            for t in range(n if len(y) else 0):
                times = draws(rid, t, seed) if bootstrap else np.ones(len(y), dtype=np.int64)
                total[t, :classes] += np.bincount(y, w * times, minlength=classes)
                total[t, classes] += np.count_nonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    flat = np.zeros(n * (classes + 1))
    for r in data.select("y", "w", "rid").mapInArrow(work, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        flat[r["at"]] = r["v"]
    return [Tree(row[:-1], int(row[-1])) for row in flat.reshape(n, -1)]


def _best_first(tree: Tree, leaves: int) -> tuple[list[int], list[int]]:
    """Splits in best-first order as far as known, and the nodes waiting then
    (best first).  Stops at a node whose children are not grown yet."""
    done, waiting = [], [0] if tree.split[0] else []
    while waiting and len(done) < leaves - 1:
        node = waiting[0]
        if tree.left[node] < 0:
            break
        done.append(waiting.pop(0))
        waiting += [c for c in (tree.left[node], tree.right[node]) if tree.split[c]]
        waiting.sort(key=lambda c: (-tree.split[c][0], c))
    return done, waiting


def _to_divide(tree: Tree, leaves: int | None) -> list[int]:
    """Nodes to be given children now: all with a split, or those that may
    come up among the leaves left."""
    if leaves is None:
        return [n for n in range(len(tree.split)) if tree.split[n] and tree.left[n] < 0]
    done, waiting = _best_first(tree, leaves)
    left = leaves - 1 - len(done)
    return [n for n in waiting[: max(left, 0)] if tree.left[n] < 0]
