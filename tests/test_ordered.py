"""Running sums, exact quantiles, AUC and null data sets when one group holds
most of the rows and lies in many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitlab.operators import profile as A
from traitlab.operators.classify import metrics as K
from traitlab.operators.cluster import kde
from traitlab.operators.ordered import running_sums


@pytest.fixture(params=[1, 37])
def spread(spark, request):
    """The session with as many ranges as given, none merged."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in names}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(n=3000, seed=6):
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.9, "hot", rng.choice(["a", "b", "c"], n))
    value = np.where(rng.random(n) < 0.3, rng.integers(0, 20, n), rng.normal(0, 1e6, n))
    return group, value


def test_running_sums_equal_numpy(spread):
    rng = np.random.default_rng(1)
    rows = [(g if g != "c" else None, int(v), int(rng.integers(0, 9))) for g in ("hot", "a", "c") for v in rng.permutation(900 if g == "hot" else 20)]
    got = {(r["g"], r["v"]): r["upto"] for r in running_sums(spread.createDataFrame(rows, "g string, v long, n long"), ["g"], ["v"], "n", "upto").collect()}
    for g in ("hot", "a", None):
        mine = sorted((v, n) for k, v, n in rows if k == g)
        assert [got[(g, v)] for v, _ in mine] == np.cumsum([n for _, n in mine]).tolist()
    empty = spread.createDataFrame([], "g string, v long, n long")
    assert running_sums(empty, ["g"], ["v"], "n", "upto").collect() == []


def test_quantiles_of_a_hot_group(spread):
    group, value = skewed()
    df = spread.createDataFrame([(g, float(v)) for g, v in zip(group, value)] + [("hot", None), ("a", float("nan")), (None, 5.0)], "g string, v double")
    got = {r["g"]: tuple(r)[1:] for r in A.five_numbers(df, ["g"], "v").collect()}
    for g in set(group):
        np.testing.assert_allclose(got[g], np.percentile(value[group == g], [0, 25, 50, 75, 100]), rtol=1e-12)
    assert got[None] == (5.0,) * 5
    np.testing.assert_allclose(A.quantiles(df.where("g is not null"), [], "v", [0.1], ["q"]).first()[0], np.percentile(value, 10), rtol=1e-12)


def test_auc_of_crowded_scores(spread):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    score = np.clip(rng.normal(0, 1e-7, 2000) + y * 1e-7, 0, 1)  # nearly all in one place
    df = spread.createDataFrame([(int(a), float(1 - s), float(s)) for a, s in zip(y, score)], "y int, prob_0 double, prob_1 double")

    def auc(pos, s):
        p, n = s[pos], s[~pos]
        return ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))

    want = (auc(y == 0, 1 - score) + auc(y == 1, score)) / 2
    assert abs(K.auc_ovr(df, [0, 1]).first()[0] - want) < 1e-12


def test_null_sets_are_permutations(spread):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    df = spread.createDataFrame([(10**12 + i, *map(float, r)) for i, r in enumerate(x)], "id long, u double, v double, w double")
    rows = kde.null_sets(df, "id", ["u", "v", "w"], 4).collect()
    sets = {}
    for r in rows:
        sets.setdefault(r[0], []).append(tuple(r)[2:])
    assert sorted(sets) == [1, 2, 3, 4]
    for held in sets.values():
        held = np.array(held)
        for j in range(3):
            assert sorted(held[:, j]) == sorted(x[:, j])
        assert abs(np.corrcoef(held[:, 0], held[:, 1])[0, 1]) < 0.2
        assert not {tuple(r) for r in held} & {tuple(r) for r in x}


def test_places_are_bijections_for_any_count(spark):
    for n in (1, 2, 97, 1000):
        got = spark.range(n).select(kde.place(F.col("id"), n, 17).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))
    big = 2**40
    ranks = spark.range(0, big, big // 64)
    got = [r[0] for r in ranks.select(kde.place(F.col("id"), big, 5)).collect()]
    assert got == [(i * (kde.multiplier(5) % big) + kde.offset(5)) % big for i in range(0, big, big // 64)]
