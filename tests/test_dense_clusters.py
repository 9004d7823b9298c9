"""DBSCAN in dense data and many dimensions, mixtures in 64 dimensions, the
silhouette's blocks: against brute force and NumPy."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitlab.operators.cluster import dbscan as DB
from traitlab.operators.cluster import gmm as G
from traitlab.operators.cluster import quality as Q
from traitlab.operators.components import min_components


def brute_dbscan(ids, x, eps, least):
    near = np.square(x[:, None] - x[None]).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = {}
    for i in np.argsort(ids):
        if core[i] and i not in label:
            stack, c = [i], len(set(label.values()))
            label[i] = c
            while stack:
                for j in np.flatnonzero(near[stack.pop()] & core):
                    if j not in label:
                        label[j] = c
                        stack.append(j)
    out = {}
    for i in range(len(x)):
        touching = [label[j] for j in np.flatnonzero(near[i] & core)]
        out[int(ids[i])] = label[i] if core[i] else min(touching, default=-1)
    return out


def points(spark, x, seed=0):
    ids = np.random.default_rng(seed).permutation(len(x)) * 3 + 10**10
    cols = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(int(i), *map(float, r)) for i, r in zip(ids, x)], "id long, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    return df, cols, ids


@pytest.mark.parametrize("dims,leaf,eps", [(2, 20, 0.35), (3, 7, 0.6), (6, 15, 1.5), (64, 25, 7.0)])
def test_dbscan_equals_brute_force_over_many_leaves(spark, monkeypatch, dims, leaf, eps):
    monkeypatch.setattr(DB, "LEAF", leaf)
    rng = np.random.default_rng(dims)
    centres = rng.normal(0, 4, (4, dims))
    x = np.vstack([c + rng.normal(0, 0.5, (60, dims)) for c in centres] + [rng.normal(0, 5, (40, dims)), np.repeat(centres[:1], 30, axis=0)])
    df, cols, ids = points(spark, x)
    got = {r["id"]: r["cluster"] for r in DB.dbscan(df, "id", cols, eps, 5).collect()}
    want = brute_dbscan(ids, x, eps, 5)
    assert got == want
    assert len(set(want.values())) > 2


def test_dbscan_of_equal_points_and_nulls(spark):
    df = spark.range(100_000).select("id", F.lit(1.5).alias("a"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("b"))
    began = time.monotonic()
    assert [tuple(r) for r in DB.dbscan(df, "id", ["a", "b"], 0.1, 5).groupBy("cluster").count().collect()] == [(0, 100_000)]
    assert time.monotonic() - began < 120
    odd = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0), (4, 1.0, 1.0)], "id long, a double, b double")
    assert dict(DB.dbscan(odd, "id", ["a", "b"], 0.1, 2).collect()) == {1: -1, 2: -1, 3: 0, 4: 0}
    assert DB.dbscan(odd.where("false"), "id", ["a", "b"], 0.1, 2).count() == 0


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 2001), (2001, 2000), (5, 5)]
    got = dict(min_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect())
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)} | {2000: 2000, 2001: 2000}


def em_twin(x, mu, k, steps, tied, reg):
    d = x.shape[1]
    pi, cov, curve = np.full(k, 1 / k), np.stack([np.eye(d)] * k), []

    def expect(pi, mu, cov):
        lp = np.stack([np.log(pi[j]) - 0.5 * (d * np.log(2 * np.pi) + np.linalg.slogdet(cov[j])[1] + np.einsum("ni,ij,nj->n", x - mu[j], np.linalg.inv(cov[j]), x - mu[j])) for j in range(k)], 1)
        top = lp.max(1, keepdims=True)
        e = np.exp(lp - top)
        return e / e.sum(1, keepdims=True), (top[:, 0] + np.log(e.sum(1))).sum()

    r, _ = expect(pi, mu, cov)
    for _ in range(steps):
        n = r.sum(0)
        pi, mu = n / len(x), (r.T @ x) / n[:, None]
        cov = np.stack([((x - mu[j]).T * r[:, j]) @ (x - mu[j]) / n[j] for j in range(k)])
        if tied:
            cov = np.stack([sum(n[j] * cov[j] for j in range(k)) / len(x)] * k)
        cov = cov + reg * np.eye(d)
        r, ll = expect(pi, mu, cov)
        curve.append(ll)
    return pi, mu, cov, curve


@pytest.mark.parametrize("covariance", ["full", "tied"])
def test_mixture_in_64_dimensions_equals_numpy(spark, covariance):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(m, 1, (150, 64)) for m in (0, 0.6, -0.6)]) + 1000.0
    df, cols, ids = points(spark, x)
    model = G.gmm(df, "id", cols, k=3, max_iter=6, tol=0.0, covariance=covariance, reg=1e-2)
    start = G.init_params(df, "id", cols, 3).means
    pi, mu, cov, curve = em_twin(x, start, 3, 6, covariance == "tied", 1e-2)
    np.testing.assert_allclose(model.loglik, curve, rtol=1e-6)
    np.testing.assert_allclose(model.params.means, mu, rtol=1e-8)
    np.testing.assert_allclose(model.params.covs, cov, atol=1e-6)
    rows = model.transform(df.select("id", *cols)).select("p_0", "p_1", "p_2", "cluster").collect()
    for r in rows:
        assert abs(r["p_0"] + r["p_1"] + r["p_2"] - 1) < 1e-9 and r["cluster"] == int(np.argmax(r[:3]))


@pytest.mark.parametrize("block", [7, 40, 1000])
def test_silhouette_over_blocks_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    x = rng.normal(size=(120, 5)) + 1e6
    x[:30] = x[0]  # copies
    label = np.r_[np.zeros(60, int), np.ones(55, int), np.full(4, 2), 3]  # a singleton too
    df, cols, _ = points(spark, np.column_stack([x, label]))
    df = df.withColumn("cluster", F.col("x5").cast("int"))
    got = Q.silhouette_frame(df, cols[:5], "cluster", block).first()[0]
    dist = np.sqrt(np.square(x[:, None] - x[None]).sum(2))
    s = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = dist[i][own].sum() / (own.sum() - 1)
        b = min(dist[i][label == c].mean() for c in set(label) - {label[i]})
        s.append((b - a) / max(a, b) if max(a, b) else 0.0)
    assert abs(got - np.mean(s)) < 1e-9
    assert "Nested" not in Q.silhouette_frame(df, cols[:5], "cluster", block)._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ batches of configurations and the result log


def test_batch_equals_single_fits_and_shares_its_passes(spark):
    from traitlab.operators.cluster import kmeans as KM
    from traitlab.operators.cluster.batch import Batch, Config

    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(m, 1, (80, 4)) for m in (0, 3, -3)])
    df, cols, _ = points(spark, x)
    start = np.array(KM.init_first_rows(df, "id", cols, 5))
    configs = [Config("KMeans", start[:k], max_iter=m) for k in (2, 5) for m in (3, 50)] + [Config("GMM", start[:k], max_iter=8, tol=t, covariance=c) for k in (2, 3) for t, c in ((1e-3, "full"), (0.0, "tied"))]
    batch = Batch.of(df, cols)
    batch.fit(configs)
    assert batch.passes <= max(50, 9) and batch.passes >= max(c.steps for c in configs)
    fitted = batch.passes
    rated = batch.rate(configs)
    assert batch.passes == fitted + 3
    for c, q in zip(configs, rated):
        if c.model == "KMeans":
            lab = KM.kmeans(df, "id", cols, k=len(c.start), max_iter=c.max_iter).assign(df)
        else:
            lab = G.gmm(df, "id", cols, k=len(c.start), max_iter=8, tol=c.tol, covariance=c.covariance).transform(df)
        want = Q.cluster_quality(lab, cols)
        for name, v in want.items():
            np.testing.assert_allclose(q[name], v, rtol=1e-8, err_msg=f"{c.model} {name}")


def test_grid_reports_collapse_and_time(spark):
    from traitlab.operators.search import cluster_grid

    df = spark.range(40).select(F.col("id").alias("row_id"), F.lit(1.0).alias("a"), F.col("id").cast("double").alias("b"))
    with pytest.raises(ValueError):
        cluster_grid(df, "row_id", {"s": ["a", "b"]}, {"Other": {}})
    late = cluster_grid(df, "row_id", {"s": ["a", "b"]}, {"KMeans": {"n_clusters": [2]}, "DBScan": {"eps": [0.5]}}, max_seconds=-1.0).collect()
    assert [r["error"] for r in late] == ["skipped: time budget"] * 2


def test_result_log_takes_a_repeated_append_once(spark, tmp_path):
    from traitlab.sources import io

    log = str(tmp_path / "log")
    row = lambda cid, v: spark.createDataFrame([(cid, v)], "config_id string, m double")
    for cid, v in (("12e4", 1.0), ("007", 2.0), ("12e4", 3.0), ("007", 2.0)):
        io.append_result(row(cid, v), log)
    assert io.finished_configs(spark, log) == {"12e4", "007"}
    read = spark.read.schema("m double, config_id string").parquet(log)
    assert sorted(tuple(r) for r in read.select("config_id", "m").collect()) == [("007", 2.0), ("12e4", 3.0)]

    class Killed(Exception):
        pass

    def dies(batches):
        raise Killed("task lost")

    with pytest.raises(Exception, match="task lost"):  # a write that never commits leaves the log as it was
        io.append_result(row("new", 9.0).mapInPandas(dies, "config_id string, m double"), log)
    assert io.finished_configs(spark, log) == {"12e4", "007"}
    with pytest.raises(ValueError):
        io.append_result(spark.range(1), log)
