"""Exact forests over a training table that one task can hold.

The trees are those of ``forest.grow_forest``: the same draws, feature choices,
candidates, ties and numbering.  Here a task grows whole trees: the table
travels as one broadcast of value codes (a feature's different values, numbered
in order), bounded by ``HELD_BYTES``, and nothing else moves but the finished
trees or, in a search, the class shares of the rows of a fold.

A round looks for the best split of all open nodes of a tree at once, over a
histogram by (class, value, node, feature), or, where a feature has many
values, over the sorted cells that occur."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.operators.classify.forest import DIGITS, ExactForest, PackedTree, Tree, draws, features_per_node, route
from traitlab.operators.sample import MAX_GROUPS, collect_bounded
from traitlab.session import scratch_table

#: bytes of a training table (codes, and a row's shares) that every task may hold
HELD_BYTES = 1 << 26
#: different values of all features that the driver numbers
HELD_VALUES = 1 << 20
#: histogram cells, or (row, feature) pairs, that are looked at together
BLOCK = 1 << 21
#: trees that a task grows, and rows whose shares are added up together
TREES, ROWS = 25, 4096


@dataclass
class Held:
    """The training table: value codes by row and feature, class, weight, row
    id for the draws, fold (-1: none)."""

    codes: np.ndarray
    values: list[np.ndarray]
    classes: list
    y: np.ndarray
    w: np.ndarray
    rid: np.ndarray
    fold: np.ndarray


def held_table(train: DataFrame, cols: Sequence[str], y: str, key: str, weight: str | None = None, fold: str | None = None) -> Held | None:
    """``train`` for the tasks, or None where it is too large for that; rows
    with a null label train nothing, null or NaN features are refused."""
    cols, p = list(cols), len(cols)
    train = train.where(F.col(y).isNotNull())
    classes = [r[0] for r in collect_bounded(train.select(y).distinct().orderBy(y), MAX_GROUPS, "classes")]
    if not classes:
        raise ValueError("no labelled rows")
    x = F.array(*[F.col(c).cast("double") for c in cols])
    code = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(y)) - 1).cast("int")
    w, at = (F.col(weight) if weight else F.lit(1.0)).cast("double"), (F.col(fold) if fold else F.lit(-1)).cast("int")
    data = scratch_table(train.select(x.alias("x"), code.alias("y"), w.alias("w"), F.xxhash64(key).alias("rid"), at.alias("fold")), "forest-train")
    if data.where(F.exists("x", lambda v: v.isNull() | F.isnan(v))).limit(1).count():
        raise ValueError("null or NaN features")
    n = data.count()
    if n * (p + 8 * len(classes)) > HELD_BYTES:
        return None
    seen = data.select(F.posexplode("x").alias("f", "v")).distinct().limit(HELD_VALUES + 1).toArrow()
    if seen.num_rows > HELD_VALUES:
        return None
    feature, value = (seen.column(c).to_numpy() for c in ("f", "v"))
    values = [np.sort(value[feature == f]) for f in range(p)]
    size = np.min_scalar_type(max(len(v) for v in values) - 1).itemsize
    if n * (p * size + 8 * len(classes)) > HELD_BYTES:
        return None
    kind = np.dtype(f"u{size}")
    shared = data.sparkSession.sparkContext.broadcast(values)

    def work(batches):
        for batch in batches:
            m = np.asarray(batch.column(0).flatten()).reshape(-1, p)
            codes = np.column_stack([np.searchsorted(v, m[:, f]) for f, v in enumerate(shared.value)]).astype(kind) if len(m) else np.empty((0, p), kind)
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in codes], pa.binary()), *batch.columns[1:]], names=["codes", *batch.schema.names[1:]])

    got = data.mapInArrow(work, "codes binary, y int, w double, rid long, fold int").toArrow()
    codes = np.frombuffer(b"".join(got.column("codes").to_pylist()), kind).reshape(-1, p)
    y_, w_, rid, fold_ = (got.column(c).to_numpy() for c in ("y", "w", "rid", "fold"))
    order = np.lexsort((y_, rid))  # whatever order the rows came in
    return Held(codes[order], values, classes, y_[order].astype(np.int64), w_[order], rid[order], fold_[order])


class Choice:
    """The features that a node of a tree may choose from, in order; kept, as
    the trees of one number choose alike in every fold and configuration."""

    def __init__(self, p: int, seed: int):
        self.p, self.seed, self.tree, self.kept = p, seed, None, {}

    def __call__(self, tree: int, node: int, subset: int) -> np.ndarray:
        if tree != self.tree:
            self.tree, self.kept = tree, {}
        if (node, subset) not in self.kept:
            self.kept[node, subset] = np.sort(np.random.default_rng([self.seed, tree, node]).choice(self.p, subset, replace=False))
        return self.kept[node, subset]


def _scores(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weighted Gini impurity of the halves by candidate; classes come first."""
    right = total - left
    nl, nr = left.sum(axis=0), right.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = 1.0 - (np.square(left).sum(axis=0) / nl + np.square(right).sum(axis=0) / nr) / (nl + nr)
    return np.where((nl > 0) & (nr > 0) & np.isfinite(score), np.round(score, DIGITS), np.inf)


def _dense(code, y, w, slot, slots, width, total, count, least):
    """Best (score, place of the feature, code) of every slot."""
    m, k = code.shape[1], len(total)
    place = (slot * m)[:, None] + np.arange(m)
    cell = code * (slots * m) + place
    cells = width * slots * m
    left = np.bincount((cell + (y * cells)[:, None]).ravel(), np.repeat(w, m), k * cells).reshape(k, width, slots, m)
    np.cumsum(left, axis=1, out=left)
    rows = np.cumsum(np.bincount(cell.ravel(), minlength=cells).reshape(width, slots, m), axis=0)
    score = _scores(left, total[:, None, :, None])
    score[(rows < least) | (count[:, None] - rows < least)] = np.inf
    flat = score.transpose(1, 2, 0).reshape(slots, -1)
    best = flat.argmin(axis=1)
    return flat[np.arange(slots), best], best // width, best % width


def _sparse(code, y, w, slot, slots, width, total, count, least):
    """The same over the (slot, feature, code) cells that occur."""
    m, k = code.shape[1], len(total)
    key, back = np.unique(((slot * m)[:, None] + np.arange(m)) * width + code, return_inverse=True)
    back = back.ravel()
    run, cells = key // width, len(key)
    left = np.bincount(back + np.repeat(y, m) * cells, np.repeat(w, m), k * cells).reshape(k, cells).cumsum(axis=1)
    rows = np.bincount(back, minlength=cells).cumsum()
    begin = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    length = np.diff(np.r_[begin, cells])
    left -= np.repeat(np.column_stack([np.zeros(k), left])[:, begin], length, axis=1)
    rows -= np.repeat(np.r_[0, rows][begin], length)
    at = run // m
    score = _scores(left, total[:, at])
    score[(rows < least) | (count[at] - rows < least)] = np.inf
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    size = np.diff(np.r_[first, cells])
    hits = np.flatnonzero(score == np.repeat(np.minimum.reduceat(score, first), size))
    best = hits[np.unique(at[hits], return_index=True)[1]]
    return score[best], run[best] % m, key[best] % width


def _best(flat, start, chosen, y, w, slot, width, total, count, least):
    """Best candidate of every slot among its chosen features; rows (their
    codes from ``start`` on) in the order of their slots, each slot with a
    row."""
    slots, m, k = len(count), chosen.shape[1], total.shape[1]
    ends = np.searchsorted(slot, np.arange(slots + 1))
    out, a = [], 0
    while a < slots:
        # as many slots as fit a block, one at least; of a large one, some features at a time
        b = max(a + 1, min(slots, int(np.searchsorted(ends, ends[a] + BLOCK // m, side="right")) - 1, a + max(1, BLOCK // (m * width * k))))
        rows = slice(ends[a], ends[b])
        n = ends[b] - ends[a]
        step = max(1, BLOCK // max(n, width * k * (b - a)) if b == a + 1 else m)
        found = None
        for j in range(0, m, step):
            part = flat[start[rows, None] + chosen[slot[rows], j : j + step]].astype(np.int64)
            way = _dense if (b - a) * width * k <= 32 * n else _sparse
            got = way(part, y[rows], w[rows], slot[rows] - a, b - a, width, total[a:b].T, count[a:b], least)
            got = (got[0], got[1] + j, got[2])
            found = got if found is None else [np.where(found[0] <= got[0], f, g) for f, g in zip(found, got)]
        out.append(found)
        a = b
    return [np.concatenate(z) for z in zip(*out)]


def _waiting(tree: Tree, leaves: int) -> tuple[list[int], list[int]]:
    """``forest._best_first`` with a heap."""
    done, waiting = [], [(-tree.split[0][0], 0)] if tree.split[0] else []
    while waiting and len(done) < leaves - 1 and tree.left[waiting[0][1]] >= 0:
        node = heapq.heappop(waiting)[1]
        done.append(node)
        for c in (tree.left[node], tree.right[node]):
            if tree.split[c]:
                heapq.heappush(waiting, (-tree.split[c][0], c))
    return done, [node for _, node in sorted(waiting)]


def grow_tree(
    held: Held,
    rows: np.ndarray,
    t: int,
    choose: Choice,
    max_depth: int | None = None,
    max_features=None,
    min_samples_leaf: int = 1,
    min_samples_split: int = 2,
    max_leaf_nodes: int | None = None,
    bootstrap: bool = True,
) -> tuple[Tree, np.ndarray]:
    """Tree ``t`` over some rows of the table, and its thresholds as codes."""
    p, k, width = held.codes.shape[1], len(held.classes), max(len(v) for v in held.values)
    subset = features_per_node(max_features, p)
    w = held.w[rows]
    if bootstrap:
        times = draws(held.rid[rows], t, choose.seed)
        rows, w = rows[times > 0], (w * times)[times > 0]
    y, at = held.y[rows], np.zeros(len(rows), dtype=np.int64)
    tree = Tree(np.bincount(y, w, minlength=k), len(rows))
    fresh, cuts, rest, flat = [0], {}, {}, held.codes.ravel()
    while True:
        nodes = []
        for node in fresh:
            if tree.count[node] >= max(min_samples_split, 2) and (max_depth is None or tree.depth[node] < max_depth) and np.count_nonzero(tree.totals[node]) > 1:
                nodes.append(node)
            else:
                tree.split[node] = False
        if nodes:
            slots = np.full(len(tree.feature), -1)
            slots[nodes] = np.arange(len(nodes))
            slot = slots[at]
            here = np.flatnonzero(slot >= 0)
            here = here[np.argsort(slot[here], kind="stable")]
            slot = slot[here]
            chosen = np.array([choose(t, node, subset) for node in nodes]) if subset < p else np.broadcast_to(np.arange(p), (len(nodes), p))
            total, count = np.array([tree.totals[n] for n in nodes]), np.array([tree.count[n] for n in nodes])
            start = rows[here] * p
            score, j, cut = _best(flat, start, chosen, y[here], w[here], slot, width, total, count, min_samples_leaf)
            feature = chosen[np.arange(len(nodes)), j]
            # totals of the halves from their rows: a class that is not there has no remainder of rounding
            half = 2 * slot + (flat[start + feature[slot]] > cut[slot])
            halves = np.bincount(half * k + y[here], w[here], 2 * len(nodes) * k).reshape(-1, 2, k)
            low = np.bincount(half, minlength=2 * len(nodes))[::2]
            size = total.sum(axis=1)
            gain = size * (1.0 - np.square(total / size[:, None]).sum(axis=1) - score)
            for i, node in enumerate(nodes):
                if np.isfinite(score[i]):
                    f = int(feature[i])
                    tree.split[node] = (gain[i], f, held.values[f][cut[i]], halves[i, 0], int(low[i]))
                    cuts[node], rest[node] = cut[i], halves[i, 1]
                else:
                    tree.split[node] = False
        if max_leaf_nodes is None:
            grown = [n for n in nodes if tree.split[n]]
        else:
            done, waiting = _waiting(tree, max_leaf_nodes)
            grown = [n for n in waiting[: max(max_leaf_nodes - 1 - len(done), 0)] if tree.left[n] < 0]
        if not grown:
            break
        fresh = list(range(len(tree.feature), len(tree.feature) + 2 * len(grown)))
        for node in grown:
            tree.divide(node)
            tree.totals[tree.right[node]] = rest[node]
        into, by, below = (np.full(fresh[0], -1) for _ in range(3))
        into[grown], by[grown], below[grown] = fresh[::2], [tree.feature[n] for n in grown], [cuts[n] for n in grown]
        move = np.flatnonzero(into[at] >= 0)
        node = at[move]
        at[move] = into[node] + (flat[rows[move] * p + by[node]] > below[node])
        if max_leaf_nodes is None:  # the other rows are in leaves
            rows, y, w, at = rows[move], y[move], w[move], at[move]
    if max_leaf_nodes is not None:
        keep = set(_waiting(tree, max_leaf_nodes)[0])
        tree.feature = [f if n in keep else -1 for n, f in enumerate(tree.feature)]
    below = np.zeros(len(tree.feature))
    below[list(cuts)] = list(cuts.values())
    return tree, below


def _growing(spark, held: Held, settings: Sequence[dict], seed: int, work, schema: str) -> DataFrame:
    """``work(held, settings, choice, unit)`` for every unit (configuration,
    first tree, end), a task each, the dearest first."""
    n, p = held.codes.shape
    units = [(c, t, min(t + TREES, s["n_estimators"])) for c, s in enumerate(settings) for t in range(0, s["n_estimators"], TREES)]

    def cost(unit):
        c, t, end = unit
        s = settings[c]
        levels = min(s.get("max_depth") or 64, np.log2(s.get("max_leaf_nodes") or n + 2) + 1)
        return (t - end) * features_per_node(s.get("max_features"), p) * levels

    units.sort(key=cost)
    shared = spark.sparkContext.broadcast((held, list(settings), units))

    def run(batches):
        held, settings, units = shared.value
        choice = Choice(held.codes.shape[1], seed)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from work(held, settings, choice, units[i])

    return spark.range(0, len(units), 1, max(1, len(units))).mapInArrow(run, schema)


def cross_validated(spark, held: Held, settings: Sequence[dict], seed: int = 42) -> list[float]:
    """Per configuration: the accuracy on each fold of the forest grown on the
    other folds, averaged over the folds."""

    def work(held, settings, choice, unit):
        c, begin, end = unit
        s = {k: v for k, v in settings[c].items() if k != "n_estimators"}
        parts = [(np.flatnonzero(held.fold != f), np.flatnonzero(held.fold == f)) for f in np.unique(held.fold)]
        share = np.zeros((len(held.y), len(held.classes)))
        for t in range(begin, end):
            for rest, out in parts:
                tree, below = grow_tree(held, rest, t, choice, **s)
                feature, _, left, right = tree.arrays()
                totals = np.array(tree.totals)
                share[out] += (totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-300))[route((feature, below, left, right), held.codes[out])]
        for a in range(0, len(share), ROWS):
            b = slice(a, a + ROWS)
            arrays = [pa.array([c], pa.int32()), pa.array([a], pa.int64()), pa.array([begin], pa.int32()), *(pa.array([z[b].tobytes()], pa.binary()) for z in (share, held.y, held.fold.astype(np.int64)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["config", "part", "first", "share", "y", "fold"])

    def judge(table: pa.Table) -> pa.Table:
        table = table.sort_by("first")  # always added up in one order
        y, fold = (np.frombuffer(table.column(c)[0].as_py(), np.int64) for c in ("y", "fold"))
        share = sum(np.frombuffer(b.as_py()) for b in table.column("share")).reshape(len(y), -1)
        of, back = np.unique(fold, return_inverse=True)
        hits = np.bincount(back, share.argmax(axis=1) == y).astype(np.int64)
        return pa.table({"config": pa.array([table.column("config")[0].as_py()] * len(of), pa.int32()), "fold": pa.array(of), "hits": pa.array(hits), "n": pa.array(np.bincount(back))})

    shares = _growing(spark, held, settings, seed, work, "config int, part long, first int, share binary, y binary, fold binary")
    judged = shares.groupBy("config", "part").applyInArrow(judge, "config int, fold long, hits long, n long")
    of: dict[int, list[float]] = {}
    for r in judged.groupBy("config", "fold").agg((F.sum("hits") / F.sum("n")).alias("a")).orderBy("config", "fold").collect():
        of.setdefault(r["config"], []).append(r["a"])
    return [float(np.mean(of[c])) for c in range(len(settings))]


def held_forest(spark, held: Held, cols: Sequence[str], settings: dict, seed: int = 42, label_type=None) -> ExactForest:
    """The forest over all rows of the table."""

    def work(held, settings, choice, unit):
        c, begin, end = unit
        s, every = {k: v for k, v in settings[c].items() if k != "n_estimators"}, np.arange(len(held.y))
        for t in range(begin, end):
            packed = PackedTree.of(grow_tree(held, every, t, choice, **s)[0])
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([packed.data], pa.binary())], names=["tree", "data"])

    got = _growing(spark, held, [settings], seed, work, "tree int, data binary").toArrow().sort_by("tree")
    return ExactForest(list(cols), held.classes, [PackedTree(b.as_py()) for b in got.column("data")], "probability", label_type)
