"""Queries for classifiers (L) and classifier metrics (K).

The SQL-checked predictions come from the nearest-centroid classifier on
the embeddings (64 values, label 0-9, 20 % test split by det); the Spark ML
estimators are rows-only checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from traitlab.operators import sample as B
from traitlab.operators.classify import metrics as K
from traitlab.operators.classify import models as L
from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register, round_doubles
from traitlab.plans.q_cluster import XS, emb_sql, sq, walsh_sql

CLASSES = list(range(10))
D = O.det_sql("vec_id")


def split_embeddings(spark, sf_dir):
    p = flows.embedding_points(spark, sf_dir)
    s = B.split(p, "vec_id", 0.2)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")


def predictions(spark, sf_dir):
    train, test = split_embeddings(spark, sf_dir)
    model = L.fit_nearest_centroid(train, XS, "label")
    pred = model.transform(test)
    return pred.select("vec_id", F.col("label").alias("y"), "p", *[f"prob_{c}" for c in model.classes]), model.classes


def pred_ctes() -> list[str]:
    means = ", ".join(f"avg({c}) AS {c}" for c in XS)
    probs = ", ".join(f"max(CASE WHEN c = {c} THEN prob END) AS prob_{c}" for c in CLASSES)
    return [
        f"pts AS ({emb_sql()})",
        f"fl AS (SELECT *, row_number() OVER (ORDER BY {D}, vec_id) <= ceil(count(*) OVER () * 0.2) AS is_test FROM pts)",
        f"cen AS (SELECT label AS c, {means} FROM fl WHERE NOT is_test GROUP BY label)",
        f"dd AS (SELECT t.vec_id, t.label AS y, cen.c, -({sq('t', 'cen')}) AS s FROM fl t JOIN cen ON TRUE WHERE t.is_test)",
        "ee AS (SELECT *, exp(s - max(s) OVER (PARTITION BY vec_id)) AS e FROM dd)",
        "pr AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS prob, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) AS rk FROM ee)",
        f"pred AS (SELECT vec_id, y, max(CASE WHEN rk = 1 THEN c END) AS p, {probs} FROM pr GROUP BY vec_id, y)",
    ]


def with_pred(*extra: str) -> str:
    return "WITH " + ",\n".join(pred_ctes() + list(extra)) + "\n"


def _l00_sql():
    probs = ", ".join(f"round(prob_{c}, 6) AS prob_{c}" for c in CLASSES)
    return with_pred() + f"SELECT vec_id, y, p, {probs} FROM pred"


@register("l00_nearest_centroid", _l00_sql)
def l00_nearest_centroid(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return round_doubles(pred)


@register("k01_accuracy", lambda: with_pred() + "SELECT round(avg(CAST(y = p AS DOUBLE)), 6) AS accuracy FROM pred")
def k01_accuracy(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return round_doubles(K.accuracy(pred))


def _k02_sql():
    unions = " UNION ALL ".join(f"SELECT {c} AS c, prob_{c} AS score, y = {c} AS pos FROM pred" for c in CLASSES)
    return with_pred(
        f"lg AS ({unions})",
        "g AS (SELECT c, score, count(*) FILTER (WHERE pos) AS np, count(*) FILTER (WHERE NOT pos) AS nn FROM lg GROUP BY c, score)",
        "cum AS (SELECT *, coalesce(sum(nn) OVER (PARTITION BY c ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)",
    ) + (
        "SELECT round(avg(auc), 6) AS auc_ovr FROM (SELECT c, sum(np * (below + 0.5 * nn)) / (sum(np) * sum(nn)) AS auc FROM cum GROUP BY c HAVING sum(np) > 0 AND sum(nn) > 0) t"
    )


@register("k02_auc_ovr", _k02_sql)
def k02_auc_ovr(spark, sf_dir):
    pred, classes = predictions(spark, sf_dir)
    return round_doubles(K.auc_ovr(pred, classes))


@register("k03_mse", lambda: with_pred() + "SELECT round(avg((y - p) * (y - p) * 1.0E0), 6) AS mse FROM pred")
def k03_mse(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return round_doubles(K.mse(pred))


def _ptrue():
    return "CASE " + " ".join(f"WHEN y = {c} THEN prob_{c}" for c in CLASSES) + " END"


@register("k04_log_loss", lambda: with_pred() + f"SELECT round(avg(-ln(greatest({_ptrue()}, 1e-15))), 6) AS log_loss FROM pred")
def k04_log_loss(spark, sf_dir):
    pred, classes = predictions(spark, sf_dir)
    return round_doubles(K.log_loss(pred, classes))


@register("k05_bic", lambda: with_pred() + f"SELECT round(avg(-ln(greatest({_ptrue()}, 1e-15))) * count(*) + {len(XS)} * ln(count(*)), 6) AS bic FROM pred")
def k05_bic(spark, sf_dir):
    pred, classes = predictions(spark, sf_dir)
    return round_doubles(K.bic(pred, classes, n_features=len(XS)))


def _pc_ctes():
    return [
        "cm AS (SELECT y, p, count(*) AS n FROM pred GROUP BY y, p)",
        "cls AS (SELECT y AS c FROM cm UNION SELECT p AS c FROM cm)",
        "cnt AS (SELECT cls.c, coalesce((SELECT sum(n) FROM cm WHERE cm.y = cls.c), 0) AS support, coalesce((SELECT sum(n) FROM cm WHERE cm.p = cls.c), 0) AS npred, "
        "coalesce((SELECT sum(n) FROM cm WHERE cm.y = cls.c AND cm.p = cls.c), 0) AS tp FROM cls)",
        "pr0 AS (SELECT *, CASE WHEN npred > 0 THEN tp * 1.0E0 / npred ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp * 1.0E0 / support ELSE 0.0 END AS recall FROM cnt)",
        "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr0)",
    ]


def _k06_sql():
    return with_pred(*_pc_ctes()) + (
        "SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall, "
        "round(sum(f1 * support) / sum(support), 6) AS f1 FROM pc"
    )


@register("k06_weighted_prf", _k06_sql)
def k06_weighted_prf(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return round_doubles(K.weighted_prf(pred))


def _k07_sql():
    return with_pred(*_pc_ctes()) + (
        "SELECT CAST(c AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc "
        "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) * 1.0E0 / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc "
        "UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM pc "
        "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
        "round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc"
    )


@register("k07_class_report", _k07_sql)
def k07_class_report(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return round_doubles(K.class_report(pred))


@register("k08_confusion", lambda: with_pred() + "SELECT y, p, count(*) AS n FROM pred GROUP BY y, p")
def k08_confusion(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return K.confusion(pred)


def _k09_sql():
    return with_pred("dist AS (SELECT p AS c, count(*) AS n FROM pred GROUP BY p)") + (
        "SELECT '{' || string_agg('\"' || CAST(c AS VARCHAR) || '\":' || CAST(n AS VARCHAR), ',' ORDER BY CAST(c AS VARCHAR)) || '}' AS pred_distribution, "
        "arg_max(c, n * 1000000 - c) AS top_class, count(*) AS n_pred_classes, (SELECT count(DISTINCT y) FROM pred) AS n_true_classes FROM dist"
    )


@register("k09_prediction_summary", _k09_sql)
def k09_prediction_summary(spark, sf_dir):
    pred, _ = predictions(spark, sf_dir)
    return K.prediction_summary(pred)


# ---------------------------------------------------------------- L7 best split


def _l07_sql():
    labels = ["Africa", "Americas", "Asia", "Europe", "Oceania", "nan"]
    from traitlab.sources.dims import SCORES

    unions = " UNION ALL ".join(f"SELECT '{s}' AS feature, {s} AS value, region_label AS y FROM rl" for s in SCORES)
    pv = ", ".join(f"count(*) FILTER (WHERE y = '{c}') AS \"{c}\"" for c in labels)
    cum = ", ".join(f"sum(\"{c}\") OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS \"l_{c}\"" for c in labels)
    tot = ", ".join(f"count(*) FILTER (WHERE y = '{c}') AS \"t_{c}\"" for c in labels)
    nl = " + ".join(f'"l_{c}"' for c in labels)
    nt = " + ".join(f'"t_{c}"' for c in labels)
    gl = "1.0 - (" + " + ".join(f'("l_{c}" / ({nl})) * ("l_{c}" / ({nl}))' for c in labels) + ")"
    gr = "1.0 - (" + " + ".join(f'(("t_{c}" - "l_{c}") / (({nt}) - ({nl}))) * (("t_{c}" - "l_{c}") / (({nt}) - ({nl})))' for c in labels) + ")"
    return O.with_clean(
        f"dim AS ({O.countries_values()})",
        "rl AS (SELECT c.*, coalesce(d.region, 'nan') AS region_label FROM clean c LEFT JOIN dim d ON c.country = d.country)",
        f"lg AS ({unions})",
        f"pvt AS (SELECT feature, value, {pv} FROM lg GROUP BY feature, value)",
        f"tt AS (SELECT feature AS f2, {tot} FROM lg GROUP BY feature)",
        f"cm AS (SELECT feature, value, {cum} FROM pvt)",
        f"cand AS (SELECT feature, value AS threshold, ((({nl}) * ({gl}) + (({nt}) - ({nl})) * ({gr})) / ({nt})) AS gini FROM cm JOIN tt ON cm.feature = tt.f2 WHERE ({nt}) - ({nl}) > 0)",
    ) + "SELECT feature, threshold, round(gini, 6) AS gini FROM cand ORDER BY gini, feature, threshold LIMIT 1"


@register("l07_best_split", _l07_sql)
def l07_best_split(spark, sf_dir):
    from traitlab.sources.dims import SCORES

    return round_doubles(L.best_split(flows.region_labelled(spark, sf_dir), SCORES, "region_label"))


# ---------------------------------------------------------------- Spark ML (rows-only)


def _ml_pred(spark, sf_dir, fit, params):
    train, test = split_embeddings(spark, sf_dir)
    fm = fit(train, XS, "label", params)
    return fm.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


@register("l01_logistic")
def l01_logistic(spark, sf_dir):
    return _ml_pred(spark, sf_dir, L.fit_logistic, {"C": 1.0, "penalty": "l2", "max_iter": 50})


@register("l03_svm")
def l03_svm(spark, sf_dir):
    return _ml_pred(spark, sf_dir, L.fit_svm, {"C": 1.0, "max_iter": 20})


@register("l05_random_forest")
def l05_random_forest(spark, sf_dir):
    return _ml_pred(spark, sf_dir, L.fit_forest, {"n_estimators": 20, "max_depth": 8, "max_features": "sqrt", "min_samples_leaf": 2})


@register("l08_mlp")
def l08_mlp(spark, sf_dir):
    """Adam on mini-batches with early stopping, ReLU; against NumPy in the
    tests."""
    train, test = split_embeddings(spark, sf_dir)
    params = {"hidden_layer_sizes": (16,), "alpha": 1e-4, "solver": "adam", "learning_rate": 0.01, "early_stopping": True, "max_iter": 30}
    fm = L.fit_mlp(train, XS, "label", params, key="vec_id")
    return fm.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


# ---------------------------------------------------------------- L2 / L4 / L9 / L11-L13

GD_STEPS, GD_LR, GD_C = 3, 0.1, 1.0


def _l02_sql():
    ctes = [f"pts AS ({walsh_sql()})", "tr AS (SELECT x1, x2, CAST(label % 2 AS INTEGER) AS y FROM pts)",
            "w0 AS (SELECT 0.0E0 AS w00, 0.0E0 AS w01, 0.0E0 AS w10, 0.0E0 AS w11, 0.0E0 AS w20, 0.0E0 AS w21)"]
    for t in range(GD_STEPS):
        ctes.append(f"z{t} AS (SELECT tr.*, w00 + w10 * x1 + w20 * x2 AS z0, w01 + w11 * x1 + w21 * x2 AS z1 FROM tr JOIN w{t} ON TRUE)")
        ctes.append(f"e{t} AS (SELECT *, exp(z0 - greatest(z0, z1)) AS e0, exp(z1 - greatest(z0, z1)) AS e1 FROM z{t})")
        ctes.append(f"p{t} AS (SELECT *, e0 / (e0 + e1) - CAST(y = 0 AS DOUBLE) AS d0, e1 / (e0 + e1) - CAST(y = 1 AS DOUBLE) AS d1 FROM e{t})")
        ctes.append(f"g{t} AS (SELECT avg(d0) AS g00, avg(d1) AS g01, avg(x1 * d0) AS g10, avg(x1 * d1) AS g11, avg(x2 * d0) AS g20, avg(x2 * d1) AS g21 FROM p{t})")
        ups = ", ".join(f"w{i}{k} - {GD_LR} * (g{i}{k} + w{i}{k} / {GD_C}) AS w{i}{k}" for i in range(3) for k in range(2))
        ctes.append(f"w{t + 1} AS (SELECT {ups} FROM w{t} JOIN g{t} ON TRUE)")
    terms = ["intercept", "x1", "x2"]
    sel = " UNION ALL ".join(f"SELECT '{terms[i]}' AS term, {k} AS cls, round(w{i}{k}, 6) AS weight FROM w{GD_STEPS}" for i in range(3) for k in range(2))
    return "WITH " + ", ".join(ctes) + " " + sel


@register("l02_softmax_gd", _l02_sql)
def l02_softmax_gd(spark, sf_dir):
    """Softmax regression by gradient descent (lr 0.1, l2 penalty W/C), two
    features, two classes (label parity), three steps (sql-k)."""
    p = flows.walsh_points(spark, sf_dir).withColumn("y", (F.col("label") % 2).cast("int"))
    m = L.fit_softmax_gd(p, ["x1", "x2"], "y", lr=GD_LR, epochs=GD_STEPS, c_reg=GD_C, classes=[0, 1])
    terms = ["intercept", "x1", "x2"]
    rows = [(terms[i], k, float(m.w[i, k])) for i in range(3) for k in range(2)]
    return round_doubles(spark.createDataFrame(rows, "term string, cls int, weight double"))


@register("l04_svm_gd")
def l04_svm_gd(spark, sf_dir):
    """One-vs-rest linear SVM by batch sub-gradient descent on all 64 values;
    against NumPy in the tests."""
    train, test = split_embeddings(spark, sf_dir)
    m = L.fit_svm_gd(train, XS, "label", epochs=20)
    return m.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


@register("l09_relu_net")
def l09_relu_net(spark, sf_dir):
    """Rows-only: ReLU network trained by distributed full-batch backprop."""
    train, test = split_embeddings(spark, sf_dir)
    net = L.fit_relu_net(train, XS, "label", hidden=(16,), lr=0.5, max_iter=15)
    return net.transform(test.select("vec_id", "label", *XS)).select("vec_id", F.col("label").alias("y"), "p")


@register("l11_us_region_model")
def l11_us_region_model(spark, sf_dir):
    """Rows-only: the US-region forest end to end (188 best-first trees of at
    most 100 leaves); its class report."""
    from traitlab.plans.workflows import us_region_model

    _m, report = us_region_model(flows.clean_survey(spark, sf_dir))
    return round_doubles(report, 4)


@register("l12_location_model")
def l12_location_model(spark, sf_dir):
    """Rows-only: region model end to end (random search with the 10 draws of
    the reference)."""
    from traitlab.plans.workflows import location_model
    from traitlab.sources.dims import country_fixture

    _best, row, _tried = location_model(flows.clean_survey(spark, sf_dir), country_fixture(spark))
    return round_doubles(row, 4)


@register("l13_cluster_model")
def l13_cluster_model(spark, sf_dir):
    """Rows-only: classifier grid predicting the C3 cluster from answers and scores."""
    from traitlab.plans.workflows import cluster_membership_model
    from traitlab.sources.dims import ITEMS, SCORES

    df = flows.labelled_survey(spark, sf_dir)
    res = cluster_membership_model(df, ITEMS + SCORES, "cluster")
    return round_doubles(res.drop("seconds"), 4)


@register("l06_forest_all_features")
def l06_forest_all_features(spark, sf_dir):
    """Ten exact trees over all 64 features (bootstrap, depth 5, majority
    vote); against brute force in the tests."""
    train, test = split_embeddings(spark, sf_dir)
    fm = L.fit_exact_forest(train, XS, "label", {"n_estimators": 10, "max_depth": 5}, key="vec_id")
    return fm.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


@register("l05_leaf_bound_forest")
def l05_leaf_bound_forest(spark, sf_dir):
    """Best-first trees of at most 12 leaves with a split bound; against brute
    force in the tests."""
    train, test = split_embeddings(spark, sf_dir)
    fm = L.fit_forest(train, XS, "label", {"n_estimators": 8, "max_depth": 30, "max_features": "sqrt", "max_leaf_nodes": 12, "min_samples_leaf": 2, "min_samples_split": 7}, key="vec_id")
    return fm.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


def _l06_sql(depth: int = 2):
    """One tree level by level: exact best split of every node that holds
    more than one class."""
    ctes = [
        f"fl AS (SELECT vec_id, label, row_number() OVER (ORDER BY {D}, vec_id) <= ceil(count(*) OVER () * 0.2) AS is_test FROM embeddings)",
        "lg AS (SELECT vec_id, unnest(range(64)) AS f, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)",
        "n0 AS (SELECT vec_id, label, is_test, 0 AS node FROM fl)",
    ]
    cnt = ", ".join(f"count(*) FILTER (WHERE label = {c}) AS c{c}" for c in CLASSES)
    run = ", ".join(f"sum(c{c}) OVER w AS l{c}, sum(c{c}) OVER (PARTITION BY node, f) AS t{c}" for c in CLASSES)
    nl, nt = " + ".join(f"l{c}" for c in CLASSES), " + ".join(f"t{c}" for c in CLASSES)
    ql = " + ".join(f"CAST(l{c} AS DOUBLE) * l{c}" for c in CLASSES)
    qr = " + ".join(f"CAST(t{c} - l{c} AS DOUBLE) * (t{c} - l{c})" for c in CLASSES)
    for i in range(depth):
        ctes += [
            f"o{i} AS (SELECT node FROM n{i} WHERE NOT is_test GROUP BY node HAVING count(DISTINCT label) > 1)",
            f"c{i} AS (SELECT node, f, v, {cnt} FROM n{i} JOIN o{i} USING (node) JOIN lg USING (vec_id) WHERE NOT is_test GROUP BY node, f, v)",
            f"r{i} AS (SELECT node, f, v, {run} FROM c{i} WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
            f"s{i} AS (SELECT node, f, v, round(1.0E0 - (({ql}) / ({nl}) + ({qr}) / (({nt}) - ({nl}))) / ({nt}), 10) AS score FROM r{i} WHERE ({nt}) > ({nl}))",
            f"b{i} AS (SELECT node, f, v FROM s{i} QUALIFY row_number() OVER (PARTITION BY node ORDER BY score, f, v) = 1)",
            f"n{i + 1} AS (SELECT n.vec_id, n.label, n.is_test, CASE WHEN b.node IS NULL THEN n.node WHEN lg.v <= b.v THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node "
            f"FROM n{i} n LEFT JOIN b{i} b ON b.node = n.node LEFT JOIN lg ON lg.vec_id = n.vec_id AND lg.f = b.f)",
        ]
    ctes.append(f"vote AS (SELECT node, label AS p FROM n{depth} WHERE NOT is_test GROUP BY node, label QUALIFY row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) = 1)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT n.vec_id, n.label AS y, vote.p FROM n{depth} n LEFT JOIN vote USING (node) WHERE n.is_test"


@register("l06_exact_tree", _l06_sql)
def l06_exact_tree(spark, sf_dir):
    """One exact tree of depth 2 over all 64 features, without bootstrap
    (sql-k); predictions of the test rows."""
    train, test = split_embeddings(spark, sf_dir)
    fm = L.fit_exact_forest(train, XS, "label", {"n_estimators": 1, "max_depth": 2, "bootstrap": False}, key="vec_id")
    return fm.transform(test, prob_prefix=None).select("vec_id", F.col("label").alias("y"), "p")


SVM_STEPS, SVM_LR, SVM_C = 3, 0.01, 1.0


def _l04k_sql():
    ctes = [f"pts AS ({walsh_sql()})", "tr AS (SELECT x1, x2, CAST(label % 2 AS INTEGER) AS y FROM pts)",
            "w0 AS (SELECT 0.0E0 AS w00, 0.0E0 AS w01, 0.0E0 AS w10, 0.0E0 AS w11, 0.0E0 AS w20, 0.0E0 AS w21)"]
    for t in range(SVM_STEPS):
        ctes.append(
            f"z{t} AS (SELECT tr.*, CASE WHEN y = 0 THEN 1.0E0 ELSE -1.0E0 END AS t0, CASE WHEN y = 1 THEN 1.0E0 ELSE -1.0E0 END AS t1, "
            f"w00 + w10 * x1 + w20 * x2 AS s0, w01 + w11 * x1 + w21 * x2 AS s1 FROM tr JOIN w{t} ON TRUE)"
        )
        ctes.append(f"a{t} AS (SELECT *, CAST(t0 * s0 < 1 AS DOUBLE) AS a0, CAST(t1 * s1 < 1 AS DOUBLE) AS a1 FROM z{t})")
        ctes.append(
            f"g{t} AS (SELECT avg(-a0 * t0) AS g00, avg(-a1 * t1) AS g01, avg(-a0 * t0 * x1) AS g10, avg(-a1 * t1 * x1) AS g11, "
            f"avg(-a0 * t0 * x2) AS g20, avg(-a1 * t1 * x2) AS g21 FROM a{t})"
        )
        ups = ", ".join(
            (f"w{i}{k} - {SVM_LR} * g{i}{k} AS w{i}{k}" if i == 0 else f"w{i}{k} - {SVM_LR} * (g{i}{k} + 2.0 * w{i}{k} / {SVM_C}) AS w{i}{k}")
            for i in range(3)
            for k in range(2)
        )
        ctes.append(f"w{t + 1} AS (SELECT {ups} FROM w{t} JOIN g{t} ON TRUE)")
    terms = ["intercept", "x1", "x2"]
    sel = " UNION ALL ".join(f"SELECT '{terms[i]}' AS term, {k} AS cls, round(w{i}{k}, 9) AS weight FROM w{SVM_STEPS}" for i in range(3) for k in range(2))
    return "WITH " + ", ".join(ctes) + " " + sel


@register("l04_svm_gd_parity", _l04k_sql)
def l04_svm_gd_parity(spark, sf_dir):
    """One-vs-rest linear SVM by batch sub-gradient (lr 0.01, reg 2w/C on the
    weights), two features, two classes (label parity), three steps (sql-k)."""
    p = flows.walsh_points(spark, sf_dir).withColumn("y", (F.col("label") % 2).cast("int"))
    m = L.fit_svm_gd(p, ["x1", "x2"], "y", lr=SVM_LR, epochs=SVM_STEPS, c_reg=SVM_C, classes=[0, 1])
    terms = ["intercept", "x1", "x2"]
    rows = [(terms[i], k, float(m.w[i, k])) for i in range(3) for k in range(2)]
    return round_doubles(spark.createDataFrame(rows, "term string, cls int, weight double"), 9)
