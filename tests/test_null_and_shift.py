"""Null classes, shifted columns, many columns, parameters, saved models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitlab.operators import features as X
from traitlab.operators import sample as B
from traitlab.operators.classify import models as L
from traitlab.operators.cluster import quality as Q


@pytest.fixture(scope="module")
def classes(spark):
    return spark.range(1, 101).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 != 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("y"), (F.col("id") % 7).cast("double").alias("x"))


def test_null_class_is_a_class(classes):
    assert B.cap_classes(classes, "y", "row_id", cap=1000).count() == 100
    assert B.cap_classes(classes, "y", "row_id", cap=10).groupBy("y").count().where("count = 10").count() == 4
    assert B.folds(classes, "row_id", 5, stratify="y").where("fold is not null").count() == 100
    part = B.split(classes, "row_id", 0.2, stratify="y")
    assert part.where("y is null and split = 'test'").count() == 5
    assert B.class_weights(classes, "y").where("weight is null").count() == 0
    assert X.minmax(classes, ["x"], by=["y"], suffix="_m").where("x_m is null").count() == 0
    coded, labels = X.encode_labels(classes, "y")
    assert labels.labels == ["c1", "c2", "c3"] and coded.where("y_code is null").count() == 25


def test_sample_of_negative_keys(spark):
    df = spark.range(-70_000, 70_000).withColumnRenamed("id", "row_id")
    assert B.sample_n(df, "row_id", 1000).count() == 1000


def test_metrics_do_not_depend_on_an_offset(spark):
    rng = np.random.default_rng(0)
    data = [(int(i % 3), float(a), float(b)) for i, (a, b) in enumerate(rng.standard_normal((300, 2)) + 2 * np.arange(300)[:, None] % 3)]
    df = spark.createDataFrame(data, "cluster int, x double, y double")
    far = df.withColumn("x", F.col("x") + 1e9).withColumn("y", F.col("y") - 1e9)
    a, b = (Q.cluster_quality(d, ["x", "y"]) for d in (df, far))
    for k in ("calinski_harabasz", "davies_bouldin", "silhouette"):
        assert a[k] == pytest.approx(b[k], rel=1e-4)


def test_moments_one_path(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 15)) * 2 + 1e9
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [tuple([None] + [1.0] * 14)], ", ".join(f"v{i} double" for i in range(15)))
    for p in (3, 12, 13, 15):
        cols = [f"v{i}" for i in range(p)]
        used = x if p else x
        n, mean, cov = X.moments(df, cols)
        assert n == 400 and np.allclose(mean, used[:, :p].mean(axis=0))
        assert np.allclose(cov, np.cov(used[:, :p].T, bias=True), atol=1e-4)


def test_factor_model_reproduces_its_covariance(spark):
    rng = np.random.default_rng(2)
    w = rng.standard_normal((2, 6))
    x = rng.standard_normal((3000, 2)) @ w + 0.3 * rng.standard_normal((3000, 6))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"v{i} double" for i in range(6)))
    m = X.fit_factor_analysis(df, [f"v{i}" for i in range(6)], 2, tol=1e-6)
    assert np.allclose(m.components.T @ m.components + np.diag(m.noise_variance), np.cov(x.T, bias=True), atol=0.05)
    assert all(b >= a - 1e-6 for a, b in zip(m.loglike, m.loglike[1:]))


def test_network_gradient_is_the_derivative():
    net = L._Net([3, 5, 4, 2])
    rng = np.random.default_rng(3)
    flat, x = net.start(1) + 0.1 * rng.standard_normal(net.ends[-1]), rng.standard_normal((7, 3))
    target = np.eye(2)[rng.integers(0, 2, 7)]

    def loss(f):
        h = x
        for m in net.layers(f)[:-1]:
            h = np.maximum(h @ m[:-1] + m[-1], 0)
        m = net.layers(f)[-1]
        z = h @ m[:-1] + m[-1]
        return -(target * (z - np.log(np.exp(z).sum(axis=1, keepdims=True)))).sum()

    g = net.gradient(flat, x, target)
    for i in rng.integers(0, len(flat), 25):
        e = np.zeros_like(flat)
        e[i] = 1e-6
        assert g[i] == pytest.approx((loss(flat + e) - loss(flat - e)) / 2e-6, abs=1e-4)


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 2))
    return spark.createDataFrame([(i, float(a), float(b), "p" if a + b > 0 else "q") for i, (a, b) in enumerate(x)], "row_id long, a double, b double, y string")


def test_parameters_have_effect_or_raise(two):
    c = lambda **p: L.fit_logistic(two, ["a", "b"], "y", p).model.coefficientMatrix.toArray()
    assert np.allclose(c(c=0.01), c(C=0.01)) and not np.allclose(c(c=0.01), c(C=1.0))
    with pytest.raises(ValueError, match="unknown parameters"):
        L.fit_forest(two, ["a", "b"], "y", {"n_trees": 3})
    m = L.fit_forest(two, ["a", "b"], "y", {"n_estimators": 2, "max_features": 1, "max_depth": 5})
    assert m.model.getFeatureSubsetStrategy() == "1" and not m.ignored_params
    deep = L.fit_forest(two, ["a", "b"], "y", {"n_estimators": 2, "max_features": 1, "max_depth": 50})
    assert isinstance(deep.model, L.ExactForest) and not deep.ignored_params
    assert any("max_depth=None" in x for x in L.fit_forest(two, ["a", "b"], "y", {"n_estimators": 2, "max_depth": None}).ignored_params)
    hinge, squared = (L.fit_svm_gd(two, ["a", "b"], "y", epochs=5, loss=x).w for x in ("hinge", "squared_hinge"))
    assert not np.allclose(hinge, squared)


def test_saved_models_score_alike(spark, two, tmp_path):
    from traitlab.sources.io import load_model, save_model

    for i, m in enumerate((L.fit_nearest_centroid(two, ["a", "b"], "y"), L.fit_softmax_gd(two, ["a", "b"], "y", epochs=3), L.fit_logistic(two, ["a", "b"], "y"), L.fit_relu_net(two, ["a", "b"], "y", hidden=(4,), max_iter=2))):
        save_model(m, str(tmp_path / f"m{i}"), spark)
        again = load_model(str(tmp_path / f"m{i}"), spark)
        a, b = (sorted((r["row_id"], r["p"]) for r in x.transform(two).collect()) for x in (m, again))
        assert a == b
