"""Exact forests, the mini-batch network and the gradient models against
brute force and NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitlab.operators.classify import forest as G
from traitlab.operators.classify import models as L
from traitlab.operators.classify import network as N


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = np.column_stack([rng.integers(0, 5, n).astype(float), rng.normal(size=n), rng.integers(0, 2, n).astype(float), rng.normal(size=n).round(1)])
    y = ((x[:, 0] > 2).astype(int) + (x[:, 1] + 0.4 * x[:, 3] > 0.3)).astype(int)
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)
    ids = np.arange(n) * 7 + 10**12
    rows = [(int(i), *map(float, r), "abc"[k]) for i, r, k in zip(ids, x, y)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, y string").repartition(4)
    rid = np.array([r[0] for r in df.select("row_id", F.xxhash64("row_id").alias("h")).orderBy("row_id").select("h").collect()])
    return df, x, y, rid


def brute_split(x, y, w, m, least, features):
    """Best (score, feature, value), thresholds at the values themselves."""
    best = None
    for f in features:
        for v in np.unique(x[m > 0, f]):
            low = x[:, f] <= v
            if m[low & (m > 0)].size < least or m[~low & (m > 0)].size < least:
                continue
            score = 0.0
            for side in (low, ~low):
                t = np.bincount(y[side], w[side], minlength=3)
                if not t.sum():
                    score = np.inf
                    break
                score += t.sum() - (t**2).sum() / t.sum()
            found = (round(score / w.sum(), G.DIGITS), f, v)
            if np.isfinite(score) and (best is None or found < best):
                best = found
    return best


def brute_tree(x, y, w, m, depth, least=1, split=2, leaves=None, features=range(4)):
    """Predictor of a tree grown by recursion or, with a leaf bound, best
    first."""
    nodes = {}

    def look(rows, level):
        t = np.bincount(y[rows], w[rows], minlength=3)
        node = {"t": t, "rows": rows, "level": level, "split": None}
        if (m[rows] > 0).sum() >= split and level < depth and np.count_nonzero(t) > 1:
            got = brute_split(x[rows], y[rows], w[rows], m[rows], least, features)
            if got:
                node["split"], node["gain"] = got[1:], t.sum() * (1 - ((t / t.sum()) ** 2).sum() - got[0])
        return node

    root = nodes[()] = look(np.flatnonzero(np.ones(len(x), bool)), 0)
    waiting, n = [((), root)], 1
    while waiting and (leaves is None or n < leaves):
        waiting = [(p, k) for p, k in waiting if k["split"]]
        if not waiting:
            break
        waiting.sort(key=lambda q: -q[1]["gain"])
        path, node = waiting.pop(0)
        f, v = node["split"]
        low = x[node["rows"], f] <= v
        for side, rows in ((0, node["rows"][low]), (1, node["rows"][~low])):
            nodes[path + (side,)] = look(rows, node["level"] + 1)
            waiting.append((path + (side,), nodes[path + (side,)]))
        n += 1

    def leaf(row):
        path = ()
        while path + (0,) in nodes:
            f, v = nodes[path]["split"]
            path += (0 if row[f] <= v else 1,)
        return nodes[path]["t"]

    return leaf, sum(1 for p in nodes if p + (0,) not in nodes)


def test_ten_exact_trees_equal_brute_force(table, spark):
    df, x, y, rid = table
    cols = ["a", "b", "c", "d"]
    model = L.fit_exact_forest(df, cols, "y", {"n_estimators": 10, "max_depth": 4}, key="row_id")
    votes = np.zeros((len(x), 3))
    for t in range(10):
        times = G.draws(rid, t, 42)
        leaf, _ = brute_tree(x, y, times.astype(float), times, 4)
        votes += np.eye(3)[[leaf(r).argmax() for r in x]]
    got = [r["p"] for r in model.transform(df, prob_prefix=None).orderBy("row_id").collect()]
    assert got == ["abc"[i] for i in votes.argmax(axis=1)]


@pytest.mark.parametrize("leaves", [2, 9, None])
def test_leaf_and_split_bounds_equal_brute_force(table, leaves):
    df, x, y, rid = table
    w = np.where(y == 1, 2.0, 1.0)
    weighted = df.withColumn("w", F.when(F.col("y") == "b", 2.0).otherwise(1.0))
    model = G.grow_forest(weighted, ["a", "b", "c", "d"], "y", key="row_id", n_estimators=3, max_depth=6, max_leaf_nodes=leaves, min_samples_leaf=3, min_samples_split=12, weight="w")
    share = np.zeros((len(x), 3))
    for t in range(3):
        times = G.draws(rid, t, 42)
        leaf, n = brute_tree(x, y, w * times, times, 6, least=3, split=12, leaves=leaves)
        kept = sum(1 for k in range(len(model.trees[t].feature)) if model.trees[t].feature[k] >= 0)
        assert kept + 1 == n and (leaves is None or n <= leaves)
        share += np.array([leaf(r) / leaf(r).sum() for r in x])
    rows = model.transform(df).orderBy("row_id").collect()
    np.testing.assert_allclose([[r["prob_a"], r["prob_b"], r["prob_c"]] for r in rows], share / 3, atol=1e-12)


def test_runs_over_many_ranges_give_the_same_trees(table, spark):
    """Every range holds a few cells, so most runs go on from range to range."""
    df, *_ = table
    settings = dict(key="row_id", n_estimators=2, max_depth=3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    one = G.grow_forest(df, ["a", "b", "c", "d"], "y", **settings)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "61")
        many = G.grow_forest(df, ["a", "b", "c", "d"], "y", **settings)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for a, b in zip(one.trees, many.trees):
        assert (a.feature, a.threshold, a.left) == (b.feature, b.threshold, b.left)


def test_forest_edges(table, spark):
    df, *_ = table
    same = df.withColumn("a", F.lit(1.0)).withColumn("y", F.lit("only"))
    model = G.grow_forest(same, ["a"], "y", n_estimators=2)
    assert {r["p"] for r in model.transform(same, prob_prefix=None).select("p").collect()} == {"only"}
    with pytest.raises(ValueError):
        G.grow_forest(df.where("false"), ["a"], "y")
    with pytest.raises(ValueError):
        G.grow_forest(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y")
    params = {"n_estimators": 2, "max_depth": 30, "max_features": "sqrt", "max_leaf_nodes": 100, "min_samples_leaf": 2, "min_samples_split": 7, "class_weight": "balanced"}
    assert L.fit_forest(df, ["a", "b"], "y", params, key="row_id").ignored_params == []


def test_exact_forest_is_saved_and_loaded(table, spark, tmp_path):
    from traitlab.sources.io import load_model, save_model

    df, *_ = table
    model = L.fit_exact_forest(df, ["a", "b", "c", "d"], "y", {"n_estimators": 3, "max_depth": 3}, key="row_id")
    net = L.fit_mlp(df, ["a", "b"], "y", {"hidden_layer_sizes": (4,), "max_iter": 2}, key="row_id")
    for name, m in (("forest", model), ("net", net)):
        save_model(m, f"{tmp_path}/{name}", spark)
        again = load_model(f"{tmp_path}/{name}", spark)
        a, b = (k.transform(df).orderBy("row_id").collect() for k in (m, again))
        assert a == b


# ------------------------------------------------------------------ network


def twin(x, y, batch, classes, hidden, activation, solver, alpha, rate, epochs, patience, tol, seed):
    """The same training in plain NumPy, gradients by layer."""
    widths = [x.shape[1], *hidden, classes]
    flat = N.start_values(widths, activation, seed)
    act, slope = N.ACTIVATIONS[activation]
    m, v, t, vel = np.zeros_like(flat), np.zeros_like(flat), 0, np.zeros_like(flat)
    rng, curve, best, waited = np.random.default_rng(seed), [], np.inf, 0

    def forward(w, b, x):
        a = [x]
        for i in range(len(w)):
            z = a[-1] @ w[i] + b[i]
            a.append(act(z) if i < len(w) - 1 else np.exp(z - z.max(1, keepdims=True)) / np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True))
        return a

    def unpack(flat):
        w, b, at = [], [], 0
        for i, o in zip(widths, widths[1:]):
            w.append(flat[at : at + i * o].reshape(i, o))
            b.append(flat[at + i * o : at + i * o + o])
            at += i * o + o
        return w, b

    for _ in range(epochs):
        loss = rows = 0
        for k in rng.permutation(batch.max() + 1):
            xb, yb = x[batch == k], y[batch == k]
            if not len(xb):
                continue
            w, b = unpack(flat)
            a = forward(w, b, xb)
            loss += -np.log(a[-1][np.arange(len(yb)), yb]).sum() + alpha / 2 * sum((z**2).sum() for z in w)
            rows += len(xb)
            delta, grads = a[-1] - np.eye(classes)[yb], []
            for i in reversed(range(len(w))):
                grads.append(np.concatenate([((a[i].T @ delta + alpha * w[i]) / len(xb)).ravel(), delta.sum(0) / len(xb)]))
                delta = (delta @ w[i].T) * slope(a[i])
            g = np.concatenate(grads[::-1])
            if solver == "adam":
                t += 1
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                flat = flat - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8 / np.sqrt(1 - 0.999**t))
            else:
                vel = 0.9 * vel - rate * g
                flat = flat + 0.9 * vel - rate * g
        held = batch == -1
        p = forward(*unpack(flat), x[held])[-1]
        curve.append([loss / rows, -np.log(p[np.arange(held.sum()), y[held]]).mean(), (p.argmax(1) == y[held]).mean()])
        waited = 0 if curve[-1][1] < best - tol else waited + 1
        best = min(best, curve[-1][1])
        if waited >= patience:
            break
    return curve


@pytest.mark.parametrize("solver,activation", [("adam", "relu"), ("sgd", "tanh")])
def test_loss_curve_equals_numpy(table, solver, activation):
    df, x, y, _ = table
    settings = dict(hidden_layer_sizes=(6, 5), activation=activation, solver=solver, alpha=0.01, learning_rate_init=0.05, max_iter=9, batch_size=60, n_iter_no_change=3, tol=1e-3)
    net = N.fit_network(df, ["a", "b", "c", "d"], "y", key="row_id", seed=3, **settings)
    batches = max(1, round(len(x) * 0.9 / 60))
    batch = np.array([r[0] for r in df.orderBy("row_id").select(N.batch_columns("row_id", batches, 0.1, 3)).collect()])
    want = twin(x, y, batch, 3, (6, 5), activation, solver, 0.01, 0.05, 9, 3, 1e-3, 3)
    np.testing.assert_allclose(net.history, want, rtol=1e-7)


def test_network_learns_and_checks_its_parameters(table):
    df, *_ = table
    fm = L.fit_mlp(df, ["a", "b", "c", "d"], "y", {"hidden_layer_sizes": (16,), "learning_rate": 0.02, "max_iter": 25, "early_stopping": False}, key="row_id")
    assert fm.transform(df).agg(F.avg((F.col("p") == F.col("y")).cast("double"))).first()[0] > 0.75
    assert fm.ignored_params == []
    with pytest.raises(ValueError):
        L.fit_mlp(df, ["a"], "y", {"solver": "lbfgs"})
    with pytest.raises(ValueError):
        L.fit_mlp(df, ["a"], "y", {"learning_rate": "adaptive"})


# ------------------------------------------------------------------ gradient models


@pytest.mark.parametrize("loss", ["hinge", "squared_hinge"])
def test_svm_descent_equals_numpy(table, loss):
    df, x, y, _ = table
    m = L.fit_svm_gd(df, ["a", "b", "c", "d"], "y", lr=0.05, epochs=12, c_reg=2.0, loss=loss)
    one, w = np.column_stack([np.ones(len(x)), x]), np.zeros((5, 3))
    for _ in range(12):
        t = np.where(np.eye(3)[y] == 1, 1.0, -1.0)
        slack = 1 - t * (one @ w)
        g = -(one.T @ ((slack > 0) * t * (2 * slack if loss == "squared_hinge" else 1))) / len(x)
        g[1:] += 2 * w[1:] / 2.0
        w = w - 0.05 * g
    np.testing.assert_allclose(m.w, w, rtol=1e-9)
    scores = one @ w
    got = [r["p"] for r in m.transform(df, prob_prefix=None).orderBy("row_id").collect()]
    assert got == ["abc"[i] for i in scores.argmax(axis=1)]


def test_null_features_are_not_scored(spark, table):
    df, *_ = table
    m = L.fit_nearest_centroid(df, ["a", "b"], "y")
    odd = spark.createDataFrame([(1, None, 1.0), (2, 1.0, float("nan")), (3, 1.0, 1.0)], "row_id long, a double, b double")
    assert [r["p"] is None for r in m.transform(odd).orderBy("row_id").collect()] == [True, True, False]


def test_order_key_takes_any_id(spark):
    from traitlab.functions.columns import DET_ADD, DET_MOD, DET_MULT, det
    from traitlab.operators import sample as B

    ids = [0, 5, 10**12, 2**62, -(10**12), 7 + 2**31]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    got = dict(df.select("row_id", det("row_id")).collect())
    for i in ids:
        r = i % DET_MOD if i >= 0 else -(-i % DET_MOD)
        z = r * DET_MULT + DET_ADD * 42
        assert got[i] == (z % DET_MOD if z >= 0 else -(-z % DET_MOD))
    assert B.sample_n(df, "row_id", 3).count() == 3
    assert B.split(df, "row_id", 0.5).where("split = 'test'").count() == 3
    assert sorted(r["fold"] for r in B.folds(df.where("row_id >= 0"), "row_id", 2).collect()) == [0, 0, 0, 1, 1]
    assert B.bootstrap(df.where("row_id >= 0"), "row_id").count() == 5
    big = spark.range(6_000_000_000, 6_000_000_050).withColumnRenamed("id", "row_id")
    assert big.select(B.perm_key("row_id", 9).alias("k")).distinct().count() == 50
