"""Steps that must not grow with the square of the input, lie in one task, or
send every task's sums to the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_survey_lines_are_made_in_many_tasks(spark, tmp_path):
    """One small file of many customers is one split; its rows are dealt out,
    null and equal keys too."""
    from traitlab.sources import survey as S

    key = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, F.lit(4)).otherwise(F.col("id"))
    rows = spark.range(60_000).select(key.alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.col("id").cast("double").alias("c_acctbal"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    plain = S.load_customer(spark, str(tmp_path))
    dealt = S.spread(plain)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 3 and max(sizes) <= 21_000
    assert dealt.exceptAll(plain).isEmpty() and dealt.count() == 60_000
    assert S.survey_lines_for(spark, str(tmp_path)).rdd.getNumPartitions() >= 3
    assert S.spread(plain.limit(5)).count() == 5


def test_region_model_cuts_its_rows_out_once(spark, monkeypatch, tmp_path):
    """The forest is trained on rows read from the written split, not cut out of
    all responses again."""
    from traitlab.plans import workflows as W

    seen = []
    monkeypatch.setattr(W.L, "fit_forest", lambda train, *a, **k: seen.append(train.inputFiles()) or (_ for _ in ()).throw(KeyError("seen")))
    df = spark.range(200).select(F.col("id").alias("row_id"), F.lit("US").alias("country"), (F.col("id") % 50 + 20.0).alias("lat"), (-F.col("id") % 60 - 66.0).cast("double").alias("lon"), F.rand(1).alias("EXT1"))
    with pytest.raises(KeyError):
        W.us_region_model(df)
    assert seen and all("us-split" in f for f in seen[0] if "class-counts" not in f and "cuts" not in f)
    assert any("us-split" in f for f in seen[0])


def test_leaves_stay_few_where_every_point_reaches_them():
    """Each leaf costs a copy of the table: many only if regions keep points apart."""
    from traitlab.operators.cluster import dbscan as DB

    rng = np.random.default_rng(3)
    wide = rng.normal(size=(3_000, 64))
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    leaves = lambda tree: int((tree[0] < 0).sum())
    assert leaves(DB.grow_tree(wide, 600_000, 0.9)) <= 25
    assert leaves(DB.grow_tree(rng.random((3_000, 2)), 200_000, 0.001)) >= 190


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_distances_from_products_decide_like_differences(offset):
    from traitlab.operators.cluster import dbscan as DB
    from traitlab.operators.cluster import quality as Q

    rng = np.random.default_rng(4)
    a = rng.normal(size=(300, 8)) + offset
    b = np.vstack([a[:40], a[:40] + 1e-7, rng.normal(size=(200, 8)) + offset, [[np.inf] * 8] if not offset else a[:1]])
    true = np.sqrt(np.square(a[:, None] - b[None]).sum(axis=2))
    for eps in (1e-7, 2.0, float(true[3, 90])):
        got = np.vstack([hit for _, hit in DB.near(a, b, eps)])
        assert (got == (np.square(a[:, None] - b[None]).sum(axis=2) <= eps * eps)).all()
    sums, others = Q.distance_sums(a, b[:-1], np.ones((len(a), 1)), np.eye(len(b) - 1), True)
    np.testing.assert_allclose(sums, true[:, :-1], rtol=1e-8, atol=1e-12)
    np.testing.assert_allclose(others[:, 0], true[:, :-1].sum(axis=0), rtol=1e-9)


def test_silhouette_of_few_blocks(spark, monkeypatch):
    """Blocks do not grow in number with the rows; values as by brute force."""
    from traitlab.operators.cluster import quality as Q

    monkeypatch.setattr(Q, "SILHOUETTE_ROWS", 10)
    monkeypatch.setattr(Q, "BLOCKS", 3)
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(90, 3)), rng.integers(0, 4, 90)
    x[:9] = x[9:18]
    y[0] = 9
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, cluster int")
    d, s = np.sqrt(np.square(x[:, None] - x[None]).sum(axis=2)), []
    for i in range(len(x)):
        mean = {c: d[i, y == c].sum() / max((y == c).sum() - (c == y[i]), 1) for c in set(y.tolist())}
        own, best = mean[y[i]], min(v for c, v in mean.items() if c != y[i])
        s.append(0.0 if (y == y[i]).sum() == 1 else (best - own) / max(own, best))
    assert Q.silhouette_frame(df, ["a", "b", "c"]).first()[0] == pytest.approx(np.mean(s), abs=1e-9)


def test_driver_takes_one_vector_of_sums(spark, monkeypatch):
    from traitlab.functions import vectors as V

    df = spark.range(0, 400, 1, 20).select(F.col("id").cast("double").alias("v"))
    taken, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: taken.append(collect(self)) or taken[-1])
    size = 10_000
    got = V.summed(df, np.arange(size), lambda p, b: p * V.matrix(b, ["v"]).sum(), size, 20)
    np.testing.assert_allclose(got, np.arange(size) * 79_800.0)
    assert sum(len(r["v"]) for r in taken[0]) == 8 * size


def test_configurations_at_one_place_share_their_sums(spark, monkeypatch):
    from traitlab.operators.cluster import batch as C

    sizes, summed = [], C.summed
    monkeypatch.setattr(C, "summed", lambda data, params, part, size, tasks=None: sizes.append(size) or summed(data, params, part, size, tasks))
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(rng.normal(size=(60, 2)).tolist(), "a double, b double")
    start = rng.normal(size=(2, 2))
    configs = [C.Config("GMM", start, max_iter=n, tol=t) for n in (3, 5) for t in (1e-3, 1e-9)]
    C.Batch.of(df, ["a", "b"]).fit(configs)
    assert set(sizes) == {configs[0].size()}
    alone = C.Config("GMM", start, max_iter=3, tol=1e-9)
    C.Batch.of(df, ["a", "b"]).fit([alone])
    np.testing.assert_allclose(alone.newest.means, configs[1].newest.means, rtol=1e-9)
    assert configs[3].steps > configs[1].steps
