"""Forests grown by tasks that hold the training table, and the search that
uses them, against brute force and the pass-wise forest."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_forest_network import brute_tree, table  # noqa: F401

from traitlab.operators import search as M
from traitlab.operators.classify import forest as G
from traitlab.operators.classify import held as H

COLS = ["a", "b", "c", "d"]


def held_of(x, y, w, rid, fold=None):
    values = [np.unique(x[:, f]) for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(v, x[:, f]) for f, v in enumerate(values)]).astype(np.uint8)
    return H.Held(codes, values, list("abc"), y.astype(np.int64), w.astype(float), rid, np.full(len(y), -1) if fold is None else fold)


@pytest.mark.parametrize("block", [1 << 21, 40])
@pytest.mark.parametrize("leaves", [2, 9, None])
def test_held_tree_equals_brute_force(table, monkeypatch, leaves, block):  # noqa: F811
    """Whole histograms, or a few cells at a time; dense and sparse ones."""
    _, x, y, rid = table
    monkeypatch.setattr(H, "BLOCK", block)
    w = np.where(y == 1, 2.0, 1.0)
    held, choose = held_of(x, y, w, rid), H.Choice(4, 42)
    for t in range(3):
        times = G.draws(rid, t, 42)
        leaf, n = brute_tree(x, y, w * times, times, 6, least=3, split=12, leaves=leaves)
        tree, below = H.grow_tree(held, np.arange(len(y)), t, choose, max_depth=6, min_samples_leaf=3, min_samples_split=12, max_leaf_nodes=leaves)
        arrays, share = H.PackedTree.of(tree)
        assert (arrays[0] < 0).sum() == n == (len(arrays[0]) + 1) // 2
        want = np.array([leaf(r) / leaf(r).sum() for r in x])
        np.testing.assert_allclose(share[G.route(arrays, x)], want, atol=1e-12)
        feature, _, left, right = tree.arrays()
        totals = np.array(tree.totals)[G.route((feature, below, left, right), held.codes)]
        np.testing.assert_allclose(totals / totals.sum(axis=1, keepdims=True), want, atol=1e-12)


def test_pure_nodes_have_no_remainder_of_rounding(table):  # noqa: F811
    _, x, y, rid = table
    held = held_of(x, y, np.array([1.3, 0.7, 1.1])[y], rid)
    tree, _ = H.grow_tree(held, np.arange(len(y)), 0, H.Choice(4, 42))
    leaf = np.array(tree.totals)[np.array(tree.feature) < 0]
    assert ((leaf == 0) | (leaf > 0.5)).all()


def test_held_forest_equals_the_forest_grown_by_passes(table, spark):  # noqa: F811
    df, *_ = table
    settings = dict(n_estimators=2, max_depth=3, max_features=2, max_leaf_nodes=6)
    one = G.grow_forest(df, COLS, "y", key="row_id", **settings)
    held = H.held_table(df, COLS, "y", "row_id")
    for t, tree in enumerate(one.trees):
        same, _ = H.grow_tree(held, np.arange(len(held.y)), t, H.Choice(4, 42), **{k: v for k, v in settings.items() if k != "n_estimators"})
        assert (tree.feature, tree.threshold, tree.left, tree.count) == (same.feature, same.threshold, same.left, same.count)
    packed = H.held_forest(spark, held, COLS, settings, 42, df.schema["y"].dataType)
    probs = [f"prob_{c}" for c in "abc"]
    a, b = (m.transform(df).orderBy("row_id").toPandas() for m in (one, packed))
    assert (a["p"] == b["p"]).all()
    np.testing.assert_allclose(a[probs], b[probs], atol=1e-12)


def test_cross_validation_equals_numpy(table, spark, monkeypatch):  # noqa: F811
    """Trees of one forest in several tasks, rows in several parts."""
    _, x, y, rid = table
    monkeypatch.setattr(H, "TREES", 2)
    monkeypatch.setattr(H, "ROWS", 50)
    held = held_of(x, y, np.ones(len(y)), rid, np.arange(len(y)) % 3)
    settings = [{"n_estimators": 5, "max_features": "sqrt", "max_leaf_nodes": 8}, {"n_estimators": 3, "max_depth": 2, "bootstrap": False}]
    want = []
    for s in settings:
        of = []
        for f in range(3):
            out, share = held.fold == f, 0
            for t in range(s["n_estimators"]):
                tree, _ = H.grow_tree(held, np.flatnonzero(~out), t, H.Choice(4, 7), **{k: v for k, v in s.items() if k != "n_estimators"})
                arrays, leaf = H.PackedTree.of(tree)
                share = share + leaf[G.route(arrays, x[out])]
            of.append(np.mean(share.argmax(axis=1) == y[out]))
        want.append(np.mean(of))
    assert H.cross_validated(spark, held, settings, 7) == pytest.approx(want, abs=1e-12)


def test_search_keeps_the_bounds_it_draws(table, tmp_path):  # noqa: F811
    """Before, folds and refit ran without them and named them ignored."""
    from traitlab.sources.io import load_model, save_model

    df, *_ = table
    best, tried = M.random_search(df, COLS, "y", {"n_estimators": [4], "max_depth": [None, 40], "max_leaf_nodes": [4], "min_samples_split": [2, 9]}, n_iter=10, folds=3)
    assert tried.count() == 4 and not best.ignored_params
    for tree in best.model.trees:
        (feature, *_), share = tree
        assert 1 < (feature < 0).sum() <= 4
    save_model(best, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    same = [m.transform(df, prob_prefix=None).orderBy("row_id").select("p").collect() for m in (best, again)]
    assert same[0] == same[1] and len(same[0]) == df.count()


def test_search_over_a_table_too_large_to_hold_gives_the_same(table, monkeypatch):  # noqa: F811
    df, *_ = table
    space = {"n_estimators": [2], "max_depth": [2], "max_features": [None], "min_samples_split": [5]}
    held = M.random_search(df, COLS, "y", space, folds=2, balanced=False)
    monkeypatch.setattr(H, "HELD_BYTES", 0)
    passes = M.random_search(df, COLS, "y", space, folds=2, balanced=False)
    a, b = (m.transform(df, prob_prefix=None).orderBy("row_id").select("p").collect() for m, _ in (held, passes))
    assert a == b and [r["cv_accuracy"] for r in held[1].collect()] == pytest.approx([r["cv_accuracy"] for r in passes[1].collect()])


def test_search_takes_null_and_repeated_keys_and_null_labels(table):  # noqa: F811
    df, *_ = table
    odd = df.withColumn("row_id", F.when(F.col("row_id") % 3 > 0, F.col("row_id") % 5)).withColumn("y", F.when(F.col("a") + F.col("d") < 5, F.col("y")))
    best, tried = M.random_search(odd, COLS, "y", {"n_estimators": [3], "min_samples_split": [4]}, folds=3)
    assert 0.5 < tried.first()["cv_accuracy"] <= 1 and best.label_map == ["a", "b", "c"]
    with pytest.raises(ValueError):
        M.random_search(odd.withColumn("a", F.lit(None).cast("double")), COLS, "y", {"min_samples_split": [4]})


def test_location_query_draws_as_often_as_the_reference(spark, monkeypatch):
    from traitlab.plans import flows, q_classify, workflows

    seen, signature = {}, inspect.signature(workflows.location_model)

    def model(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        seen.update(bound.arguments)
        return None, spark.range(1), None

    monkeypatch.setattr(workflows, "location_model", model)
    monkeypatch.setattr(flows, "clean_survey", lambda *_: spark.range(1))
    q_classify.l12_location_model(spark, "nowhere")
    assert (seen["n_iter"], seen["folds"]) == (10, 3)
