"""Golden cases and invariants checked against brute force on small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from traitlab.functions.columns import DET_ADD, DET_MOD, DET_MULT, guarded_number, us_region
from traitlab.operators import sample as B
from traitlab.operators.classify import metrics as K
from traitlab.operators.cluster import kmeans as KM
from traitlab.operators.cluster import quality as Q
from traitlab.operators.enrich import eps_pairs, fold_rare
from traitlab.operators.features import fit_factor_analysis, minmax, standardize


def det_py(k, seed=42):
    return (k * DET_MULT + DET_ADD * seed) % DET_MOD


def test_guarded_number(spark):
    vals = ["1", " 3 ", "1e2", ".5", "-2.", "1d", "2f", "nan", "inf", "NULL", "", None, "+4.25"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(guarded_number("t")).collect()]
    assert got == [1.0, 3.0, 100.0, 0.5, -2.0, None, None, None, None, None, None, None, 4.25]


def test_country_code_na_stays_text(spark, tmp_path):
    from traitlab.sources.io import country_dim

    p = tmp_path / "c.csv"
    p.write_text('name,country,region,sub-region,intermediate-region\nNamibia,NA,Africa,Sub-Saharan Africa,Southern Africa\n"Korea, Republic of",KR,Asia,Eastern Asia,\n')
    rows = country_dim(spark, str(p)).collect()
    assert rows[0]["country"] == "NA" and rows[1]["name"] == "Korea, Republic of"


def test_us_region_boundaries(spark):
    pts = [(36.5, -82.0, "Northeast"), (49.0, -104.0, "Midwest"), (24.5, -75.0, "South"), (31.0, -125.0, "West"), (0.0, 0.0, "Unknown/Outside U.S."), (None, -90.0, "Unknown/Outside U.S.")]
    df = spark.createDataFrame([(a, b) for a, b, _ in pts], "lat double, lon double")
    got = [r[0] for r in df.select(us_region("lat", "lon")).collect()]
    assert got == [e for _, _, e in pts]


@pytest.fixture(scope="module")
def keyed(spark):
    rng = np.random.default_rng(1)
    n = 700
    pdf = pd.DataFrame({"row_id": np.arange(n) * 3 + 5, "g": rng.choice(["a", "b", "c", "d"], n, p=[0.6, 0.2, 0.15, 0.05])})
    # two ids that collide in det (differ by 2**31) to exercise the tie level
    pdf.loc[len(pdf)] = [7 + (1 << 31), "a"]
    pdf.loc[len(pdf)] = [7, "a"]
    return spark.createDataFrame(pdf), pdf


def brute_first(pdf, n, by=None):
    pdf = pdf.assign(d=pdf.row_id.map(det_py)).sort_values(["d", "row_id"])
    if by is None:
        return set(pdf.row_id.head(n))
    return set(pdf.groupby(by).head(n).row_id)


@pytest.mark.parametrize("n", [0, 1, 37, 500, 10_000])
def test_first_n_global_matches_sort(keyed, n):
    df, pdf = keyed
    got = {r[0] for r in B.first_n(df, "row_id", n).select("row_id").collect()}
    assert got == brute_first(pdf, n)


def test_first_n_per_group_matches_sort(keyed):
    df, pdf = keyed
    got = {r[0] for r in B.cap_classes(df, "g", "row_id", cap=30).select("row_id").collect()}
    assert got == brute_first(pdf, 30, by="g")


def test_split_sizes_disjoint(keyed):
    df, pdf = keyed
    s = B.split(df, "row_id", 0.2).toPandas()
    assert (s.split == "test").sum() == math.ceil(0.2 * len(pdf))
    assert s.row_id.is_unique and len(s) == len(pdf)


def test_det_rank_matches_sort(keyed):
    df, pdf = keyed
    got = B.det_rank(df, "row_id", by=["g"]).toPandas().set_index("row_id")["rank"]
    exp = pdf.assign(d=pdf.row_id.map(det_py)).sort_values(["d", "row_id"])
    exp["rank"] = exp.groupby("g").cumcount()
    assert (got.sort_index() == exp.set_index("row_id")["rank"].sort_index()).all()


def test_level_largest(keyed):
    df, pdf = keyed
    out = B.level_largest(df, "g", "row_id").groupBy("g").count().toPandas().set_index("g")["count"]
    counts = pdf.g.value_counts()
    assert out["a"] == counts.iloc[1] and out["b"] == counts["b"]


def test_fold_rare(spark):
    df = spark.createDataFrame([("US", "Americas")] * 5 + [("NA", "Africa")] * 2 + [("TW", None)], "country string, region string")
    got = sorted({tuple(r) for r in fold_rare(df, "country", "region", min_count=3, out="f").select("country", "f").collect()})
    assert got == [("NA", "Africa"), ("TW", "TW"), ("US", "US")]


def test_eps_pairs_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.random((150, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "k long, a double, b double")
    got = {(r.i, r.j) for r in eps_pairs(df, "k", ["a", "b"], 0.08).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    exp = {(i, j) for i in range(150) for j in range(150) if d2[i, j] <= 0.08**2}
    assert got == exp


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(c, 0.3, (40, 3)) for c in ([0, 0, 0], [2, 2, 0], [0, 3, 3])])
    lab = np.repeat([0, 1, 2], 40)
    lab[0] = 7  # a singleton cluster
    pdf = pd.DataFrame(pts, columns=["a", "b", "c"]).assign(label=lab)
    return spark.createDataFrame(pdf), pdf


def np_silhouette(x, lab, squared=False):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    if not squared:
        d = np.sqrt(d)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == u].mean() for u in np.unique(lab) if u != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouettes_brute_force(blobs):
    df, pdf = blobs
    x, lab = pdf[["a", "b", "c"]].to_numpy(), pdf.label.to_numpy()
    assert Q.silhouette(df, ["a", "b", "c"], "label") == pytest.approx(np_silhouette(x, lab), rel=1e-9)
    assert Q.silhouette_sq(df, ["a", "b", "c"], "label") == pytest.approx(np_silhouette(x, lab, True), rel=1e-9)


def test_ch_db_brute_force(blobs):
    df, pdf = blobs
    x, lab = pdf[["a", "b", "c"]].to_numpy(), pdf.label.to_numpy()
    ks = np.unique(lab)
    mu = x.mean(axis=0)
    cents = {k: x[lab == k].mean(axis=0) for k in ks}
    between = sum((lab == k).sum() * ((cents[k] - mu) ** 2).sum() for k in ks)
    within = sum(((x[lab == k] - cents[k]) ** 2).sum() for k in ks)
    ch = (between / (len(ks) - 1)) / (within / (len(x) - len(ks)))
    assert Q.calinski_harabasz(df, ["a", "b", "c"], "label") == pytest.approx(ch, rel=1e-9)
    scat = {k: np.linalg.norm(x[lab == k] - cents[k], axis=1).mean() for k in ks}
    db = np.mean([max((scat[i] + scat[j]) / np.linalg.norm(cents[i] - cents[j]) for j in ks if j != i) for i in ks])
    assert Q.davies_bouldin(df, ["a", "b", "c"], "label") == pytest.approx(db, rel=1e-9)


def test_degenerate_one_cluster(blobs):
    df, _ = blobs
    one = df.withColumn("one", F.lit(0))
    q = Q.cluster_quality(one, ["a", "b", "c"], "one", exact_silhouette=False)
    assert q["calinski_harabasz"] == -1.0 and math.isinf(q["davies_bouldin"]) and q["silhouette"] == -1.0


def test_entropy_and_found(blobs):
    df, pdf = blobs
    noisy = df.withColumn("label", F.when(F.col("a") > 2.5, F.lit(-1)).otherwise(F.col("label")))
    p = pdf.label.value_counts(normalize=True)
    assert Q.cluster_entropy(df, "label") == pytest.approx(float(-(p * np.log(p)).sum()), rel=1e-12)
    lab = noisy.select("label").toPandas().label
    assert Q.clusters_found(noisy, "label") == lab[lab != -1].nunique()


def test_kmeans_empty_cluster_keeps_centre(spark):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(10)], "k long, a double")
    model = KM.kmeans(df, "k", ["a"], k=3, max_iter=5, init=[[0.0], [1.0], [100.0]])
    assert model.centers[2] == [100.0]
    assert sorted(c[0] for c in model.centers[:2]) == [0.0, 1.0]


def test_auc_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 300
    y = rng.integers(0, 3, n)
    prob = rng.dirichlet([1, 1, 1], n).round(2)  # rounding creates ties
    pdf = pd.DataFrame({"y": y, "p": prob.argmax(axis=1), **{f"prob_{c}": prob[:, c] for c in range(3)}})
    got = K.auc_ovr(spark.createDataFrame(pdf), [0, 1, 2]).first()[0]
    aucs = []
    for c in range(3):
        pos, neg = prob[y == c, c], prob[y != c, c]
        aucs.append(np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]))
    assert got == pytest.approx(float(np.mean(aucs)), rel=1e-12)


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (6.0,)], "a double")
    out, sc = standardize(df, ["a"])
    assert sc.std[0] == pytest.approx(np.std([1, 2, 3, 6]))
    vals = [r[0] for r in out.collect()]
    assert np.mean(vals) == pytest.approx(0.0, abs=1e-12)


def test_minmax_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = minmax(df, ["a", "b"], suffix="_mm").collect()
    assert [r.a_mm for r in rows] == [0.0, 1.0] and all(r.b_mm is None for r in rows)


def test_factor_analysis_reconstructs_covariance(spark):
    rng = np.random.default_rng(11)
    w = rng.normal(0, 1, (2, 6))
    z = rng.normal(0, 1, (4000, 2))
    x = z @ w + rng.normal(0, 0.5, (4000, 6))
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"v{i}" for i in range(6)]))
    m = fit_factor_analysis(df, [f"v{i}" for i in range(6)], n_factors=2)
    cov = np.cov(x.T, bias=True)
    approx = m.components.T @ m.components + np.diag(m.noise_variance)
    assert np.abs(approx - cov).max() < 0.1
    assert all(ll2 >= ll1 - 1e-6 for ll1, ll2 in zip(m.loglike, m.loglike[1:]))


def test_eps_pairs_high_dim_grid_on_three(spark):
    rng = np.random.default_rng(9)
    x = rng.random((120, 5))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double, d double, e double")
    got = {(r.i, r.j) for r in eps_pairs(df, "k", list("abcde"), 0.35).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    assert got == {(i, j) for i in range(120) for j in range(120) if d2[i, j] <= 0.35**2}


def test_best_split_continuous_brute_force(spark):
    from traitlab.operators.classify.models import best_split

    rng = np.random.default_rng(13)
    n = 400
    pdf = pd.DataFrame({"f1": rng.normal(0, 1, n).round(3), "f2": rng.random(n).round(2), "y": rng.choice(["a", "b", "c"], n)})
    pdf.loc[pdf.f2 > 0.7, "y"] = "a"
    got = best_split(spark.createDataFrame(pdf), ["f1", "f2"], "y", buckets=8).first()

    def gini(lab):
        if len(lab) == 0:
            return 0.0
        p = lab.value_counts(normalize=True)
        return 1.0 - float((p**2).sum())

    best = None
    for f in ["f1", "f2"]:
        for t in sorted(pdf[f].unique()):
            left, right = pdf[pdf[f] <= t].y, pdf[pdf[f] > t].y
            if len(right) == 0:
                continue
            g = (len(left) * gini(left) + len(right) * gini(right)) / n
            cand = (round(g, 12), f, t)
            best = cand if best is None or cand < best else best
    assert (got.feature, got.threshold) == (best[1], best[2]) and got.gini == pytest.approx(best[0], abs=1e-9)


def test_silhouette_is_exact_beyond_one_block(spark):
    import numpy as np
    from traitlab.operators.cluster.quality import silhouette_frame

    rng = np.random.default_rng(12)
    x = [(int(k), float(a), float(b)) for k, a, b in zip(rng.integers(0, 3, 150), rng.normal(size=150), rng.normal(size=150))]
    x += [(0, 0.5, 0.5)] * 75 + [(7, 9.0, 9.0)]
    k, v = np.array([r[0] for r in x]), np.array([r[1:] for r in x])
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    want = []
    for i in range(len(x)):
        own = (k == k[i]).sum()
        a = d[i, k == k[i]].sum() / max(own - 1, 1)
        b = min(d[i, k == j].mean() for j in set(k.tolist()) - {int(k[i])})
        want.append(0.0 if own == 1 else (b - a) / max(a, b))
    df = spark.createDataFrame(x, "cluster int, a double, b double").repartition(3)
    for size in (2000, 40):
        got = silhouette_frame(df, ["a", "b"], "cluster", size).first()[0]
        assert abs(got - np.mean(want)) < 1e-9
