"""Queries for clustering and cluster metrics (C1-C15) on the embeddings
table (all 64 values; the mixture, DBSCAN and KDE queries on two signed sums
of all of them; the stored ``label`` is the given cluster)."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators.cluster import kmeans as KM
from traitlab.operators.cluster import quality as Q
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles

XS = [f"x{i}" for i in range(1, flows.N_VALUES + 1)]


def emb_sql() -> str:
    cols = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i + 1}" for i in range(flows.N_VALUES))
    return f"SELECT vec_id, label, {cols} FROM embeddings"


def walsh_sql(dims: int = 2, prefix: str = "x", keep: bool = False) -> str:
    """Signed sums of all values, as ``flows.walsh_points``."""
    val = [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(flows.N_VALUES)]
    sums = [val[0] + "".join((" + " if flows.walsh_sign(j, i) > 0 else " - ") + val[i] for i in range(1, flows.N_VALUES)) for j in range(dims)]
    every = "".join(f"{v} AS x{i + 1}, " for i, v in enumerate(val)) if keep else ""
    return f"SELECT vec_id, label, {every}" + ", ".join(f"({s}) / 8.0E0 AS {prefix}{j + 1}" for j, s in enumerate(sums)) + " FROM embeddings"


def sq(a: str, b: str, cols=XS) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


def _c09_sql():
    means = ", ".join(f"avg({c}) AS {c}" for c in XS)
    return (
        f"WITH p AS ({emb_sql()}), c AS (SELECT label, count(*) AS n, {means} FROM p GROUP BY label), g AS (SELECT {means} FROM p), "
        f"bt AS (SELECT sum(c.n * ({sq('c', 'g')})) AS b, count(*) AS k, sum(c.n) AS n FROM c JOIN g ON TRUE), "
        f"wt AS (SELECT sum({sq('p', 'c')}) AS w FROM p JOIN c ON p.label = c.label) "
        "SELECT round(CASE WHEN k < 2 THEN -1.0 WHEN w <= 0 THEN 0.0 ELSE (b / (k - 1)) / (w / (n - k)) END, 6) AS calinski_harabasz FROM bt JOIN wt ON TRUE"
    )


@register("c09_calinski_harabasz", _c09_sql)
def c09_calinski_harabasz(spark, sf_dir):
    return round_doubles(Q.calinski_harabasz_frame(flows.embedding_points(spark, sf_dir), XS, "label"))


def _c10_sql():
    means = ", ".join(f"avg({c}) AS {c}" for c in XS)
    return (
        f"WITH p AS ({emb_sql()}), c AS (SELECT label, {means} FROM p GROUP BY label), "
        f"s AS (SELECT c.*, sc.s FROM c JOIN (SELECT p.label, avg(sqrt({sq('p', 'c')})) AS s FROM p JOIN c ON p.label = c.label GROUP BY p.label) sc ON c.label = sc.label), "
        f"r AS (SELECT a.label, max(CASE WHEN sqrt({sq('a', 'b')}) > 0 THEN (a.s + b.s) / sqrt({sq('a', 'b')}) END) AS r FROM s a JOIN s b ON a.label <> b.label GROUP BY a.label) "
        "SELECT round(avg(coalesce(r, 0.0)), 6) AS davies_bouldin FROM r"
    )


@register("c10_davies_bouldin", _c10_sql)
def c10_davies_bouldin(spark, sf_dir):
    return round_doubles(Q.davies_bouldin_frame(flows.embedding_points(spark, sf_dir), XS, "label"))


def _c11_sql():
    return f"WITH p AS ({emb_sql()}), q AS (SELECT vec_id, CASE WHEN x1 < -0.1 THEN -1 ELSE label END AS cluster FROM p) SELECT count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS n_clusters_found FROM q"


@register("c11_clusters_found", _c11_sql)
def c11_clusters_found(spark, sf_dir):
    """Labels with rows of x1 < -0.1 marked as noise (-1)."""
    p = flows.embedding_points(spark, sf_dir)
    q = p.select(F.when(F.col("x1") < -0.1, F.lit(-1)).otherwise(F.col("label")).alias("cluster"))
    return Q.clusters_found_frame(q, "cluster")


def _c12_sql():
    return (
        f"WITH p AS ({emb_sql()}), c AS (SELECT label, count(*) AS n FROM p GROUP BY label) "
        "SELECT round(-sum((n * 1.0E0 / t) * ln(n * 1.0E0 / t)), 6) AS cluster_entropy FROM c JOIN (SELECT sum(n) AS t FROM c) tt ON TRUE"
    )


@register("c12_cluster_entropy", _c12_sql)
def c12_cluster_entropy(spark, sf_dir):
    return round_doubles(Q.cluster_entropy_frame(flows.embedding_points(spark, sf_dir), "label"))


def _sil_sql(squared: bool, name: str):
    dist = sq("a", "b") if squared else f"sqrt({sq('a', 'b')})"
    return (
        f"WITH p AS ({emb_sql()}), d AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, {dist} AS dist FROM p a JOIN p b ON a.vec_id <> b.vec_id), "
        "m AS (SELECT i, li, lj, sum(dist) / count(*) AS md FROM d GROUP BY i, li, lj), "
        "ab AS (SELECT i, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b FROM m GROUP BY i) "
        f"SELECT round(avg(CASE WHEN ab.a IS NULL THEN 0.0 ELSE (ab.b - ab.a) / greatest(ab.a, ab.b) END), 6) AS {name} FROM p LEFT JOIN ab ON p.vec_id = ab.i"
    )


@register("c13_silhouette", lambda: _sil_sql(False, "silhouette"))
def c13_silhouette(spark, sf_dir):
    return round_doubles(Q.silhouette_frame(flows.embedding_points(spark, sf_dir), XS, "label"))


@register("c13_silhouette_sq", lambda: _sil_sql(True, "silhouette_sq"))
def c13_silhouette_sq(spark, sf_dir):
    return round_doubles(Q.silhouette_sq_frame(flows.embedding_points(spark, sf_dir), XS, "label"))


def _c15_sql():
    return (
        f"WITH p AS ({emb_sql()}), k AS (SELECT count(DISTINCT 0) AS k FROM p) "
        "SELECT CASE WHEN k < 2 THEN -1.0 END AS calinski_harabasz, CASE WHEN k < 2 THEN 'Infinity'::DOUBLE END AS davies_bouldin, "
        "CASE WHEN k < 2 THEN -1.0 END AS silhouette_sq FROM k"
    )


@register("c15_degenerate_labels", _c15_sql)
def c15_degenerate_labels(spark, sf_dir):
    """All rows in one cluster: CH -1, DB +inf, silhouette -1."""
    p = flows.embedding_points(spark, sf_dir).withColumn("one", F.lit(0))
    q = Q.cluster_quality(p, XS, "one")
    return spark.createDataFrame([(float(q["calinski_harabasz"]), float(q["davies_bouldin"]), float(q["silhouette"]))], "calinski_harabasz double, davies_bouldin double, silhouette_sq double")


def _c03_sql():
    return f"WITH p AS ({emb_sql()}), " + O.nearest_first_k_ctes("p", XS, 4, key="vec_id") + " SELECT vec_id, cluster FROM lab"


@register("c03_assign_nearest", _c03_sql)
def c03_assign_nearest(spark, sf_dir):
    p = flows.embedding_points(spark, sf_dir)
    centers = KM.init_first_rows(p, "vec_id", XS, 4)
    return KM.assign_nearest(p, XS, centers).select("vec_id", "cluster")


def _c01_sql(iters: int = 3, k: int = 4):
    D = O.det_sql("vec_id")
    cols = ", ".join(XS)
    ctes = [f"p AS ({emb_sql()})", f"cen0 AS (SELECT row_number() OVER (ORDER BY {D}, vec_id) - 1 AS cid, {cols} FROM p ORDER BY {D}, vec_id LIMIT {k})"]
    for it in range(1, iters + 1):
        prev = f"cen{it - 1}"
        ctes.append(
            f"a{it} AS (SELECT vec_id, cid FROM (SELECT p.vec_id, c.cid, row_number() OVER (PARTITION BY p.vec_id ORDER BY {sq('p', 'c')}, c.cid) AS rn FROM p JOIN {prev} c ON TRUE) t WHERE rn = 1)"
        )
        ctes.append(f"m{it} AS (SELECT a.cid, " + ", ".join(f"avg(p.{c}) AS {c}" for c in XS) + f" FROM a{it} a JOIN p ON a.vec_id = p.vec_id GROUP BY a.cid)")
        ctes.append(f"cen{it} AS (SELECT c.cid, " + ", ".join(f"coalesce(m.{c}, c.{c}) AS {c}" for c in XS) + f" FROM {prev} c LEFT JOIN m{it} m ON c.cid = m.cid)")
    return "WITH " + ", ".join(ctes) + f" SELECT CAST(cid AS INTEGER) AS cluster, " + ", ".join(f"round({c}, 4) AS {c}" for c in XS) + f" FROM cen{iters}"


@register("c01_kmeans_parity", _c01_sql)
def c01_kmeans_parity(spark, sf_dir):
    """Lloyd K-Means, k=4, started from the first 4 rows by det, 3 updates."""
    p = flows.embedding_points(spark, sf_dir)
    model = KM.kmeans(p, "vec_id", XS, k=4, max_iter=3, tol=0.0)
    rows = [(i, *c) for i, c in enumerate(model.centers)]
    out = spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in XS))
    return round_doubles(out, 4)


@register("c01_kmeans_ml")
def c01_kmeans_ml(spark, sf_dir):
    """Rows-only: Spark ML K-Means (k-means|| init) labels of the embeddings."""
    p = flows.embedding_points(spark, sf_dir)
    out, _model = KM.kmeans_ml(p, XS, k=4, max_iter=20, seed=42)
    return out.select("vec_id", "cluster")


@register("c02_uniform_box_init")
def c02_uniform_box_init(spark, sf_dir):
    """Rows-only: K-Means from a seeded uniform-box start (C2), final labels."""
    p = flows.embedding_points(spark, sf_dir)
    model = KM.kmeans(p, "vec_id", XS, k=4, max_iter=20, init="box", seed=42)
    return model.assign(p).select("vec_id", "cluster")


# ---------------------------------------------------------------- C4, C5, C7, C8: Gaussian mixture

GMM_K = 2
X2 = ["x1", "x2"]


def _gmm_ctes(steps: int = 2, k: int = GMM_K, tied: bool = False) -> list[str]:
    """EM in SQL for two features (closed-form 2x2 inverse); th<i> = params
    after i M-steps, r<i> = responsibilities under th<i>."""
    D = O.det_sql("vec_id")
    ctes = [
        f"p AS ({walsh_sql()})",
        "nn AS (SELECT count(*) AS n FROM p)",
        f"th0 AS (SELECT row_number() OVER (ORDER BY {D}, vec_id) - 1 AS cid, 1.0E0 / {k} AS pi, x1 AS m1, x2 AS m2, 1.0E0 AS s11, 0.0E0 AS s12, 1.0E0 AS s22 FROM p ORDER BY {D}, vec_id LIMIT {k})",
    ]

    def e_step(i):
        return [
            f"lp{i} AS (SELECT p.vec_id, p.x1, p.x2, t.cid, ln(t.pi) - ln(2 * pi()) - 0.5 * ln(t.s11 * t.s22 - t.s12 * t.s12) - 0.5 * "
            f"((t.s22 * (p.x1 - t.m1) * (p.x1 - t.m1) - 2 * t.s12 * (p.x1 - t.m1) * (p.x2 - t.m2) + t.s11 * (p.x2 - t.m2) * (p.x2 - t.m2)) / (t.s11 * t.s22 - t.s12 * t.s12)) AS lp "
            f"FROM p JOIN th{i} t ON TRUE)",
            f"mx{i} AS (SELECT *, max(lp) OVER (PARTITION BY vec_id) AS m FROM lp{i})",
            f"ex{i} AS (SELECT *, exp(lp - m) AS e FROM mx{i})",
            f"r{i} AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS r, m + ln(sum(e) OVER (PARTITION BY vec_id)) AS llrow FROM ex{i})",
        ]

    for i in range(steps):
        ctes += e_step(i)
        ctes.append(
            f"ag{i + 1} AS (SELECT cid, sum(r) AS nk, sum(r * x1) AS sx1, sum(r * x2) AS sx2, sum(r * x1 * x1) AS q11, sum(r * x1 * x2) AS q12, sum(r * x2 * x2) AS q22 FROM r{i} GROUP BY cid)"
        )
        full = (
            f"fc{i + 1} AS (SELECT cid, nk, nk / nn.n AS pi, sx1 / nk AS m1, sx2 / nk AS m2, q11 / nk - (sx1 / nk) * (sx1 / nk) AS s11, "
            f"q12 / nk - (sx1 / nk) * (sx2 / nk) AS s12, q22 / nk - (sx2 / nk) * (sx2 / nk) AS s22 FROM ag{i + 1} JOIN nn ON TRUE)"
        )
        ctes.append(full)
        if tied:
            ctes.append(
                f"th{i + 1} AS (SELECT f.cid, f.pi, f.m1, f.m2, t.s11, t.s12, t.s22 FROM fc{i + 1} f JOIN "
                f"(SELECT sum(nk * s11) / max(nn.n) AS s11, sum(nk * s12) / max(nn.n) AS s12, sum(nk * s22) / max(nn.n) AS s22 FROM fc{i + 1} JOIN nn ON TRUE) t ON TRUE)"
            )
        else:
            ctes.append(f"th{i + 1} AS (SELECT cid, pi, m1, m2, s11, s12, s22 FROM fc{i + 1})")
    ctes += e_step(steps)
    return ctes


def _gmm_params_sql(tied=False):
    return "WITH " + ", ".join(_gmm_ctes(tied=tied)) + (
        " SELECT CAST(cid AS INTEGER) AS cluster, round(pi, 4) AS pi, round(m1, 4) AS m1, round(m2, 4) AS m2, round(s11, 6) AS s11, round(s12, 6) AS s12, round(s22, 6) AS s22 FROM th2"
    )


def _gmm_frame(spark, model):
    th = model.params
    rows = [(j, float(th.weights[j]), float(th.means[j][0]), float(th.means[j][1]), float(th.covs[j][0, 0]), float(th.covs[j][0, 1]), float(th.covs[j][1, 1])) for j in range(len(th.weights))]
    df = spark.createDataFrame(rows, "cluster int, pi double, m1 double, m2 double, s11 double, s12 double, s22 double")
    return df.select("cluster", *[F.round(c, 4).alias(c) for c in ("pi", "m1", "m2")], *[F.round(c, 6).alias(c) for c in ("s11", "s12", "s22")])


def _fit_gmm(spark, sf_dir, tied=False):
    from traitlab.operators.cluster import gmm as G

    p = flows.walsh_points(spark, sf_dir)
    return p, G.gmm(p, "vec_id", X2, k=GMM_K, max_iter=2, tol=0.0, covariance="tied" if tied else "full", reg=0.0)


@register("c04_gmm_parity", _gmm_params_sql)
def c04_gmm_parity(spark, sf_dir):
    """Full-covariance EM, k=2 on two features, two EM steps from the first
    2 rows by det (sql-k)."""
    _p, model = _fit_gmm(spark, sf_dir)
    return _gmm_frame(spark, model)


@register("c05_gmm_tied", lambda: _gmm_params_sql(tied=True))
def c05_gmm_tied(spark, sf_dir):
    _p, model = _fit_gmm(spark, sf_dir, tied=True)
    return _gmm_frame(spark, model)


def _c07_sql():
    return "WITH " + ", ".join(_gmm_ctes()) + (
        " SELECT vec_id, round(max(CASE WHEN cid = 0 THEN r END), 4) AS p_0, round(max(CASE WHEN cid = 1 THEN r END), 4) AS p_1, "
        "CAST(arg_max(cid, lp * 1.0E0 - cid * 1e-300) AS INTEGER) AS cluster FROM r1 GROUP BY vec_id"
    )


@register("c07_gmm_responsibilities", _c07_sql)
def c07_gmm_responsibilities(spark, sf_dir):
    """Soft assignment and label from the last E-step (parameters after one
    M-step when two were run)."""
    p, model = _fit_gmm(spark, sf_dir)
    out = model.transform(p).select("vec_id", "p_0", "p_1", "cluster")
    return round_doubles(out, 4)


def _c08_sql():
    return "WITH " + ", ".join(_gmm_ctes()) + " SELECT round(sum(llrow), 4) AS log_likelihood FROM (SELECT DISTINCT vec_id, llrow FROM r2) t"


@register("c08_gmm_loglik", _c08_sql)
def c08_gmm_loglik(spark, sf_dir):
    from traitlab.operators.cluster import gmm as G

    p, model = _fit_gmm(spark, sf_dir)
    return round_doubles(spark.createDataFrame([(G.log_likelihood(p, X2, model.params),)], "log_likelihood double"), 4)


def _wide_gmm(spark, sf_dir, covariance):
    from traitlab.operators.cluster import gmm as G

    p = flows.embedding_points(spark, sf_dir)
    return p, G.gmm(p, "vec_id", XS, k=3, max_iter=10, tol=1e-4, covariance=covariance, reg=1e-3)


@register("c04_gmm_wide")
def c04_gmm_wide(spark, sf_dir):
    """Full-covariance mixture of three on all 64 values: responsibilities and
    labels; against NumPy in the tests."""
    p, model = _wide_gmm(spark, sf_dir, "full")
    return round_doubles(model.transform(p.select("vec_id", *XS)).drop(*XS), 4)


@register("c05_gmm_tied_wide")
def c05_gmm_tied_wide(spark, sf_dir):
    """Tied mixture of three on all 64 values: log-likelihood by iteration."""
    _p, model = _wide_gmm(spark, sf_dir, "tied")
    return round_doubles(spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.loglik, 1)], "iteration int, log_likelihood double"), 4)


@register("c04_gmm_ml")
def c04_gmm_ml(spark, sf_dir):
    """Rows-only: Spark ML GaussianMixture labels on two features."""
    from traitlab.operators.cluster import gmm as G

    p = flows.walsh_points(spark, sf_dir)
    out, _m = G.gmm_ml(p, X2, k=3, max_iter=50)
    return out.select("vec_id", "cluster")


# ---------------------------------------------------------------- C6 DBSCAN

DB_EPS, DB_MIN = 0.2, 6


def _c06_sql():
    D2 = "(a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)"
    return (
        f"WITH RECURSIVE raw AS ({walsh_sql()}), st AS (SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2 FROM raw), "
        "p AS (SELECT vec_id, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2 FROM raw JOIN st ON TRUE), "
        f"pairs AS (SELECT a.vec_id AS i, b.vec_id AS j FROM p a JOIN p b ON {D2} <= CAST({DB_EPS * DB_EPS!r} AS DOUBLE)), "
        f"core AS (SELECT i FROM pairs GROUP BY i HAVING count(*) >= {DB_MIN}), "
        "ce AS (SELECT pairs.i, pairs.j FROM pairs WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)), "
        "reach(i, j) AS (SELECT i, j FROM ce UNION SELECT reach.i, ce.j FROM reach JOIN ce ON reach.j = ce.i), "
        "comp AS (SELECT i, min(j) AS root FROM reach GROUP BY i), "
        "cid AS (SELECT i, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM comp), "
        "border AS (SELECT pr.i, min(cid.cluster) AS cluster FROM pairs pr JOIN cid ON pr.j = cid.i WHERE pr.i NOT IN (SELECT i FROM core) GROUP BY pr.i) "
        "SELECT p.vec_id, CAST(coalesce(cid.cluster, border.cluster, -1) AS INTEGER) AS cluster FROM p LEFT JOIN cid ON p.vec_id = cid.i LEFT JOIN border ON p.vec_id = border.i"
    )


@register("c06_dbscan", _c06_sql)
def c06_dbscan(spark, sf_dir):
    """DBSCAN on two standardised features (eps 0.2, min_samples 6)."""
    from traitlab.operators.cluster.dbscan import dbscan
    from traitlab.operators.features import standardize

    p = flows.walsh_points(spark, sf_dir)
    z, _sc = standardize(p, X2)
    return dbscan(z, "vec_id", X2, eps=DB_EPS, min_samples=DB_MIN)


def _c06_wide_sql():
    return (
        f"WITH RECURSIVE p AS ({emb_sql()}), pairs AS (SELECT a.vec_id AS i, b.vec_id AS j FROM p a JOIN p b ON {sq('a', 'b')} <= CAST({WIDE_EPS * WIDE_EPS!r} AS DOUBLE)), "
        f"core AS (SELECT i FROM pairs GROUP BY i HAVING count(*) >= {WIDE_MIN}), "
        "ce AS (SELECT pairs.i, pairs.j FROM pairs WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)), "
        "reach(i, j) AS (SELECT i, j FROM ce UNION SELECT reach.i, ce.j FROM reach JOIN ce ON reach.j = ce.i), "
        "comp AS (SELECT i, min(j) AS root FROM reach GROUP BY i), "
        "cid AS (SELECT i, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM comp), "
        "border AS (SELECT pr.i, min(cid.cluster) AS cluster FROM pairs pr JOIN cid ON pr.j = cid.i WHERE pr.i NOT IN (SELECT i FROM core) GROUP BY pr.i) "
        "SELECT p.vec_id, CAST(coalesce(cid.cluster, border.cluster, -1) AS INTEGER) AS cluster FROM p LEFT JOIN cid ON p.vec_id = cid.i LEFT JOIN border ON p.vec_id = border.i"
    )


WIDE_EPS, WIDE_MIN = 0.9, 3


@register("c06_dbscan_wide", _c06_wide_sql)
def c06_dbscan_wide(spark, sf_dir):
    """DBSCAN on all 64 values (eps 0.9, min_samples 3)."""
    from traitlab.operators.cluster.dbscan import dbscan

    return dbscan(flows.embedding_points(spark, sf_dir), "vec_id", XS, eps=WIDE_EPS, min_samples=WIDE_MIN)


# ---------------------------------------------------------------- C14 KDE enrichment

KDE_B = 20


def _c14_sql():
    from traitlab.operators.cluster.kde import multiplier, offset, stream_of

    D = O.det_sql("vec_id")
    ctes = [
        f"p AS ({walsh_sql()})",
        "c AS (SELECT label, avg(x1) AS m1, avg(x2) AS m2 FROM p GROUP BY label)",
        "bw AS (SELECT ((stddev_pop(x1) + stddev_pop(x2)) / 2) * pow(count(*), -1.0E0 / 6) AS h FROM p)",
        "real AS (SELECT c.label, avg(exp(-((p.x1 - c.m1) * (p.x1 - c.m1) + (p.x2 - c.m2) * (p.x2 - c.m2)) / (2 * bw.h * bw.h))) AS density FROM p JOIN c ON TRUE JOIN bw ON TRUE GROUP BY c.label)",
        f"rk AS (SELECT x1, x2, row_number() OVER (ORDER BY {D}, vec_id) - 1 AS r, count(*) OVER () AS n FROM p)",
    ]
    nulls = []
    for b in range(1, KDE_B + 1):
        for j, col in enumerate(X2):
            s = stream_of(b, j)
            ctes.append(f"r{b}_{j} AS (SELECT (r * {multiplier(s)} + {offset(s)}) % n AS rk, {col} FROM rk)")
        ctes.append(f"n{b} AS (SELECT {b} AS b, a.x1, z.x2 FROM r{b}_0 a JOIN r{b}_1 z ON a.rk = z.rk)")
        nulls.append(f"SELECT * FROM n{b}")
    ctes.append("nl AS (" + " UNION ALL ".join(nulls) + ")")
    ctes.append(
        "nd AS (SELECT nl.b, c.label, avg(exp(-((nl.x1 - c.m1) * (nl.x1 - c.m1) + (nl.x2 - c.m2) * (nl.x2 - c.m2)) / (2 * bw.h * bw.h))) AS nd FROM nl JOIN c ON TRUE JOIN bw ON TRUE GROUP BY nl.b, c.label)"
    )
    return "WITH " + ", ".join(ctes) + (
        " SELECT r.label AS cluster, round(r.density, 6) AS density, round(avg(nd.nd), 6) AS null_mean, round(r.density / avg(nd.nd), 6) AS enrichment, "
        f"round((count(*) FILTER (WHERE nd.nd >= r.density) + 1) / {KDE_B + 1}.0E0, 6) AS p_value FROM real r JOIN nd ON r.label = nd.label GROUP BY r.label, r.density"
    )


@register("c14_kde_enrichment", _c14_sql)
def c14_kde_enrichment(spark, sf_dir):
    """KDE density at each label centre vs column-permuted nulls (20 draws)."""
    from traitlab.operators.cluster.kde import kde_enrichment

    p = flows.walsh_points(spark, sf_dir)
    return round_doubles(kde_enrichment(p, "vec_id", X2, "label", n_null=KDE_B))
