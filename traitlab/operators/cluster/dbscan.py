"""DBSCAN (C6) in any number of dimensions, without a list of pairs.

Equal points are one entry with a count.  A k-d tree, cut at medians of a
bounded sample, divides space into leaves of about ``LEAF`` entries (the sample
decides sizes alone, never the result).  Every entry goes to its own leaf and,
as a guest, to each leaf whose region comes within eps of it; a task then holds
one leaf and sees its guests batch by batch.

1. Degrees: counts of own entries and guests within eps -> core entries.
2. Links: the core entries of a leaf are joined to components inside the task;
   a guest that is core gives one link to each component it touches, an entry
   that is not core one link to each core neighbour (fewer than
   ``min_samples``).
3. Components of these links over all leaves (``components.py``).
4. Cluster ids 0..C-1 ordered by the smallest core member; a border point (not
   core, with a core neighbour) takes the lowest neighbouring cluster id;
   everything else, and rows with a null feature, is noise (-1).

The result does not depend on partitioning or row order.  In many dimensions,
or with an eps as wide as the data, most entries are guests of most leaves: the
distances then grow with the square of the different points, as the method's
do; what is sent is one copy of the table per leaf, and leaves are then as few
as memory allows (``grow_tree``)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitlab.functions.vectors import lifted
from traitlab.operators.classify.forest import route
from traitlab.operators.components import min_components
from traitlab.session import scratch_table

#: different points in a leaf, by expectation, where few points are guests
LEAF = 1_000
#: else leaves grow while a point is a guest of more than so many, down to so
#: many leaves, or until a leaf has so many bytes
GUESTS, LEAVES, LEAF_BYTES = 8, 24, 16 << 20
#: points of the sample that the tree is cut from
SAMPLE = 50_000


def ordered_ids(values: DataFrame, col: str, out: str) -> DataFrame:
    """0-based position of each distinct value in sorted order: range
    partitions, the offset of each (one row per partition), and the row number
    inside it.  No task sorts all values."""
    parts = scratch_table(values.select(col).repartitionByRange(col).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy(F.col("a._part").alias("_part")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(col)) - 1
    return parts.join(F.broadcast(before), "_part").select(col, (F.col("_off") + inside).alias(out))


def cut_space(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, ...]:
    """k-d tree (feature, threshold, left, right) with about ``leaves``
    leaves: the widest side is cut at its median."""
    feature, threshold, left, right = [-1], [0.0], [-1], [-1]
    open_ = [(0, sample)]
    while open_ and len(feature) < 2 * leaves - 1:
        open_.sort(key=lambda q: -len(q[1]))
        node, rows = open_.pop(0)
        if len(rows) < 2:
            break
        side = np.ptp(rows, axis=0)
        f = int(side.argmax())
        if side[f] == 0:
            continue
        v = float(np.median(rows[:, f]))
        low = rows[:, f] <= v
        if low.all():  # the median is the maximum
            v = float(rows[rows[:, f] < v, f].max())
            low = rows[:, f] <= v
        feature[node], threshold[node], left[node], right[node] = f, v, len(feature), len(feature) + 1
        for part in (rows[low], rows[~low]):
            open_.append((len(feature), part))
            feature.append(-1)
            threshold.append(0.0)
            left.append(-1)
            right.append(-1)
    return np.array(feature), np.array(threshold), np.array(left), np.array(right)


def grow_tree(sample: np.ndarray, n: int, eps: float) -> tuple[np.ndarray, ...]:
    """Tree for ``n`` entries.  Small leaves pay where their regions keep
    points apart; where most points reach most leaves (many dimensions, wide
    eps) every leaf costs another copy of the table, so leaves are few."""
    size = 8 * (sample.shape[1] + 4)
    leaves = -(-n // LEAF)
    fewest = min(leaves, max(LEAVES, -(-n * size // LEAF_BYTES)))
    while True:
        tree, some = cut_space(sample, leaves), sample[:1_000]
        if leaves <= fewest or len(reached(tree, some, eps)[0]) <= GUESTS * len(some):
            return tree
        leaves = max(fewest, leaves // 4)


def reached(tree: tuple[np.ndarray, ...], x: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, row) for every leaf whose region comes within eps of a row on
    each axis, its own included."""
    feature, threshold, left, right = tree
    leaves, rows, stack = [], [], [(0, np.arange(len(x)))]
    while stack:
        node, at = stack.pop()
        if not len(at):
            continue
        if feature[node] < 0:
            leaves.append(np.full(len(at), node))
            rows.append(at)
            continue
        v = x[at, feature[node]]
        stack.append((left[node], at[v - eps <= threshold[node]]))
        stack.append((right[node], at[v + eps >= threshold[node]]))
    return (np.concatenate(leaves), np.concatenate(rows)) if leaves else (np.empty(0, np.int64), np.empty(0, np.int64))


def _col(batch, name):
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _points(batch, d):
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def near(a: np.ndarray, b: np.ndarray, eps: float):
    """(first row of a, which of these rows and all of b are within eps), in
    steps of bounded size.  Distances come from products; those that rounding
    leaves in doubt are decided by the differences."""
    left, right, slack = lifted(a, b)
    if not np.isfinite(slack):
        step = max(1, 1_000_000 // max(1, b.size))
        for i in range(0, len(a), step):
            yield i, np.square(a[i : i + step, None] - b[None]).sum(axis=2) <= eps * eps
        return
    step = max(1, 1_000_000 // max(1, len(b)))
    for i in range(0, len(a), step):
        d = left[i : i + step] @ right.T
        d -= eps * eps
        hit = d <= 0
        doubt = np.abs(d, out=d) <= slack
        if doubt.any():
            row, col = np.nonzero(doubt)
            for at in range(0, len(row), 65_536):
                r, c = row[at : at + 65_536], col[at : at + 65_536]
                hit[r, c] = np.square(a[i + r] - b[c]).sum(axis=1) <= eps * eps
        yield i, hit


def near_counts(a: np.ndarray, b: np.ndarray, weight: np.ndarray, eps: float) -> np.ndarray:
    """Weight of the rows of b within eps of each row of a."""
    one = bool((weight == 1).all())
    parts = [np.count_nonzero(hit, axis=1) if one else (hit @ weight.astype(float)).astype(np.int64) for _, hit in near(a, b, eps)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def near_pairs(a: np.ndarray, b: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within eps, where few are expected."""
    found = [np.nonzero(hit) + (i,) for i, hit in near(a, b, eps)]
    return (np.concatenate([r + i for r, _, i in found]), np.concatenate([c for _, c, _ in found])) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def local_components(x: np.ndarray, eps: float) -> np.ndarray:
    """Position of the first member of each row's component."""
    root = np.full(len(x), -1)
    for first in range(len(x)):
        if root[first] >= 0:
            continue
        root[first], front = first, np.array([first])
        while len(front):
            free = np.flatnonzero(root < 0)
            hit = np.zeros(len(free), dtype=bool)
            for _, found in near(x[front], x[free], eps):
                hit |= found.any(axis=0)
            front = free[hit]
            root[front] = first
    return root


def _dealt(points: DataFrame, shared, d: int, eps: float) -> DataFrame:
    """Every entry to its own leaf and, as guest, to all leaves it reaches."""

    def work(batches):
        tree = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch, d)
            own = route(tree, x)
            leaf, at = reached(tree, x, eps)
            for a in range(0, len(at), 4096):
                i, to = at[a : a + 4096], leaf[a : a + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(own[i] != to), pa.array(_col(batch, "k")[i]), pa.array(_col(batch, "c")[i]), pa.array(_col(batch, "core")[i]), _lists(x[i])], names=["leaf", "guest", "k", "c", "core", "x"])

    dealt = points.mapInArrow(work, "leaf long, guest boolean, k long, c long, core boolean, x array<double>")
    # few leaves would share tasks by chance: more partitions than leaves
    leaves = int((np.asarray(shared.value[0]) < 0).sum())
    spread = dealt.repartition(4 * leaves, "leaf") if leaves <= LEAVES else dealt.repartition("leaf")
    return spread.sortWithinPartitions("leaf", "guest", "k")


def _leaves(batches, d: int):
    """(own, guests) of every leaf: own = (k, c, core, x), guests an iterator
    of the same.  The guests must be used up before the next leaf."""

    def runs():
        for batch in batches:
            leaf, guest = _col(batch, "leaf"), _col(batch, "guest")
            data = (_col(batch, "k"), _col(batch, "c"), _col(batch, "core"), _points(batch, d))
            change = np.flatnonzero((leaf[1:] != leaf[:-1]) | (guest[1:] != guest[:-1])) + 1
            for a, b in zip([0, *change], [*change, len(leaf)]):
                if b > a:
                    yield int(leaf[a]), bool(guest[a]), tuple(v[a:b] for v in data)

    stream, held = runs(), [None]

    def pull():
        held[0] = next(stream, None)

    def guests(leaf):
        while held[0] and held[0][0] == leaf and held[0][1]:
            yield held[0][2]
            pull()

    pull()
    while held[0]:
        leaf, own = held[0][0], []
        while held[0] and held[0][0] == leaf and not held[0][1]:
            own.append(held[0][2])
            pull()
        if own:
            yield tuple(np.concatenate(z) for z in zip(*own)), guests(leaf)
        for _ in guests(leaf):  # a leaf without own entries
            pass


def _core_entries(d: int, eps: float, min_samples: int):
    def work(batches):
        for (k, c, _, x), guests in _leaves(batches, d):
            degree = near_counts(x, x, c, eps)
            for _, gc, _, gx in guests:
                degree = degree + near_counts(x, gx, gc, eps)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(degree >= min_samples), _lists(x)], names=["k", "c", "core", "x"])

    return work


def _links(d: int, eps: float):
    """kind 0: (core entry, first core entry of its component); 1: (core guest,
    first entry of a component it touches); 2: (border entry, core neighbour).
    Components are those of pieces of a leaf; the core entries of a later piece
    are guests of the earlier ones."""

    def touches(gk, gx, pieces):
        for ck, cx, first, at in pieces:
            for i, hit in near(gx, cx, eps):
                # each component once per guest; the piece lies in their order
                row, comp = np.nonzero(np.logical_or.reduceat(hit, first, axis=1))
                yield 1, gk[i + row], ck[at[comp]]

    def work(batches):
        for (k, _, core, x), guests in _leaves(batches, d):
            out = []
            ck, cx = k[core], x[core]
            bk, bx = k[~core], x[~core]
            pieces = []
            for s in range(0, len(ck), LEAF):
                pk, px = ck[s : s + LEAF], cx[s : s + LEAF]
                root = local_components(px, eps)
                out.append((0, pk, pk[root]))
                out += touches(pk, px, pieces)
                order = np.argsort(root, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(root[order]) > 0])
                pieces.append((pk, px[order], first, root[order][first]))
            i, j = near_pairs(bx, cx, eps)
            out.append((2, bk[i], ck[j]))
            for gk, _, gcore, gx in guests:
                gk, gx = gk[gcore], gx[gcore]
                out += touches(gk, gx, pieces)
                i, j = near_pairs(bx, gx, eps)
                out.append((2, bk[i], gk[j]))
            kind = np.concatenate([np.full(len(a), z, dtype=np.int32) for z, a, _ in out])
            a, b = (np.concatenate([o[i] for o in out]).astype(np.int64) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    return work


def dbscan(df: DataFrame, key: str, cols: Sequence[str], eps: float = 0.5, min_samples: int = 5, out: str = "cluster") -> DataFrame:
    """(key, cluster) for every row; -1 = noise.  ``key`` is an integer id."""
    cols, d = list(cols), len(cols)
    # -0.0 and 0.0 are one value
    x = F.array(*[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in cols])
    rows = df.select(F.col(key).cast("long").alias("k"), x.alias("x")).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    entries = scratch_table(rows.groupBy("x").agg(F.min("k").alias("k"), F.count("*").alias("c")).withColumn("core", F.lit(False)), "dbscan-entries")
    n = entries.count()
    if not n:
        return df.select(key, F.lit(-1).alias(out))
    sample = entries.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).collect() if n > LEAF else []
    tree = grow_tree(np.array([r["x"] for r in sample]), n, eps) if sample else cut_space(np.zeros((0, d)), 1)
    shared = df.sparkSession.sparkContext.broadcast(tree)
    schema = "k long, c long, core boolean, x array<double>"
    cores = scratch_table(_dealt(entries, shared, d, eps).mapInArrow(_core_entries(d, eps, min_samples), schema), "dbscan-core")
    links = scratch_table(_dealt(cores, shared, d, eps).mapInArrow(_links(d, eps), "kind int, a long, b long"), "dbscan-links")
    joined = min_components(links.where("kind < 2"))
    roots = scratch_table(links.where("kind = 0").select(F.col("a").alias("v")).join(joined, "v", "left").select("v", F.coalesce("root", "v").alias("root")), "dbscan-roots")
    ids = ordered_ids(roots.select("root").distinct(), "root", out)
    core_label = roots.join(ids, "root").select("v", F.col(out).cast("int").alias(out))
    border = links.where("kind = 2").join(core_label, F.col("b") == F.col("v")).groupBy("a").agg(F.min(out).alias(out)).withColumnRenamed("a", "v")
    labels = scratch_table(core_label.unionByName(border), "dbscan-labels")
    by_entry = entries.select("x", F.col("k").alias("v")).join(labels, "v")
    both = rows.join(by_entry.select("x", out), "x").select(F.col("k"), out)
    return df.select(key).join(both.withColumnRenamed("k", "_k"), F.col(key) == F.col("_k"), "left").select(key, F.coalesce(out, F.lit(-1)).cast("int").alias(out))
