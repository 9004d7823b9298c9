"""Model search (M1-M4).

The grid itself is a handful of configurations (a driver-side list).  K-Means
and mixtures over one feature table are fitted and rated together: one pass
over the table serves every configuration that is still open (``batch.py``).
Each finished configuration goes to a result log (Parquet, one partition per
configuration, so that a repeated write replaces and never doubles it), and a
restart skips configurations already in the log.  A time budget is checked
before every pass.  A collapsed mixture and a configuration out of time become
result rows with an ``error`` text; any other exception is raised."""

from __future__ import annotations

import hashlib
import itertools
import json
import time
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.functions.vectors import with_scores
from traitlab.operators.cluster import quality as Q
from traitlab.operators.cluster.batch import Batch, Config, batch_labels

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("config_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("factor_analysis", T.BooleanType()),
        T.StructField("params", T.StringType()),
        T.StructField("calinski_harabasz", T.DoubleType()),
        T.StructField("davies_bouldin", T.DoubleType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("n_clusters_found", T.LongType()),
        T.StructField("cluster_entropy", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def param_grid(space: Mapping[str, Sequence]) -> list[dict]:
    """M4: cartesian product of the value lists (keys in the given order)."""
    keys = list(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def param_table(spark: SparkSession, space: Mapping[str, Sequence]) -> DataFrame:
    """M4 as a table: one row per configuration, parameters as JSON text."""
    return spark.createDataFrame([(json.dumps(p, sort_keys=True),) for p in param_grid(space)], "params string")


def config_id(model: str, data_type: str, fa: bool, params: dict) -> str:
    return hashlib.sha1(json.dumps([model, data_type, fa, params], sort_keys=True).encode()).hexdigest()[:16]


def _config(model: str, params: dict, start) -> Config:
    if model == "KMeans":
        return Config("KMeans", start, max_iter=int(params.get("max_iter", 100)), tol=float(params.get("tol", 1e-6)))
    return Config("GMM", start, max_iter=int(params.get("max_iter", 100)), tol=float(params.get("tol", 1e-4)), covariance=params.get("covariance_type", "full"))


def _clusters_asked(model: str, params: dict) -> int:
    return int(params.get("n_clusters", 5) if model == "KMeans" else params.get("n_components", 3))


def cluster_grid(
    df: DataFrame,
    key: str,
    feature_sets: Mapping[str, Sequence[str]],
    space: Mapping[str, Mapping[str, Sequence]],
    factor_analysis: Sequence[bool] = (False,),
    n_factors: int = 5,
    max_seconds: float = float("inf"),
    result_log: str | None = None,
    exact_silhouette: bool = False,
) -> DataFrame:
    """M1: fit every (model, feature set, FA switch, parameters) configuration,
    score it with the internal metrics and return one row per configuration.
    ``silhouette`` is the squared-distance form unless ``exact_silhouette``;
    ``seconds`` of configurations fitted together is their share."""
    from traitlab.operators.cluster.dbscan import dbscan
    from traitlab.operators.cluster.kmeans import init_first_rows
    from traitlab.operators.features import factor_scores, standardize
    from traitlab.sources.io import append_result, finished_configs
    from traitlab.session import scratch_table

    if unknown := set(space) - {"KMeans", "GMM", "DBScan"}:
        raise ValueError(f"unknown models {sorted(unknown)}")
    spark = df.sparkSession
    done = finished_configs(spark, result_log) if result_log else set()
    rows = []
    start = time.monotonic()
    in_time = lambda: time.monotonic() - start <= max_seconds

    def record(model, data_type, fa, params, q, seconds, error):
        values = [q.get(m) for m in ("calinski_harabasz", "davies_bouldin", "silhouette", "n_clusters_found", "cluster_entropy")]
        row = (config_id(model, data_type, fa, params), model, data_type, fa, json.dumps(params, sort_keys=True), *values, seconds, error)
        rows.append(row)
        if result_log and not (error or "").startswith("skipped"):
            append_result(spark.createDataFrame([row], RESULT_SCHEMA), result_log)

    for data_type, cols in feature_sets.items():
        base = df.select(key, *cols)
        for fa in factor_analysis:
            wanted = [(m, p) for m, pspace in space.items() for p in param_grid(pspace) if config_id(m, data_type, fa, p) not in done]
            if not wanted:
                continue
            feats, fcols = base, list(cols)
            if fa:
                fcols = [f"factor_{j}" for j in range(1, min(n_factors, len(cols)) + 1)]
                feats = factor_scores(base, list(cols), len(fcols))[0].select(key, *fcols)
            feats = scratch_table(standardize(feats, fcols)[0], "grid-features")
            together = [(m, p) for m, p in wanted if m != "DBScan"]
            if together:
                t0 = time.monotonic()
                batch = Batch.of(feats, fcols)
                first = np.array(init_first_rows(feats, key, fcols, max(_clusters_asked(m, p) for m, p in together)))
                configs = [_config(m, p, first[: _clusters_asked(m, p)]) for m, p in together]
                batch.fit(configs, in_time)
                rated = batch.rate(configs)
                seconds = (time.monotonic() - t0) / len(configs)
                for (m, p), c, q in zip(together, configs, rated):
                    if exact_silhouette and q:
                        scored = with_scores(feats, fcols, c.scorer(c.labels_by), lambda s, x: batch_labels(s, x)[:, None], 1, "_l")
                        q = q | {"silhouette": Q.silhouette(scored.withColumn("cluster", F.get("_l", F.lit(0)).cast("int")), fcols)}
                    record(m, data_type, fa, p, q, seconds, c.error)
            for m, p in wanted:
                if m != "DBScan":
                    continue
                if not in_time():
                    record(m, data_type, fa, p, {}, 0.0, "skipped: time budget")
                    continue
                t0 = time.monotonic()
                lab = feats.join(dbscan(feats, key, fcols, eps=float(p.get("eps", 0.5)), min_samples=int(p.get("min_samples", 5))), key)
                q = Q.cluster_quality(scratch_table(lab, "grid-labels"), fcols, "cluster", exact_silhouette=exact_silhouette)
                record(m, data_type, fa, p, {k: (int if k == "n_clusters_found" else float)(v) for k, v in q.items()}, time.monotonic() - t0, None)
    if result_log:
        skipped = spark.createDataFrame([r for r in rows if (r[-1] or "").startswith("skipped")], RESULT_SCHEMA)
        return spark.read.schema(RESULT_SCHEMA).parquet(result_log).unionByName(skipped) if done or len(rows) > skipped.count() else skipped
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def classifier_grid(
    train: DataFrame,
    test: DataFrame,
    cols: Sequence[str],
    y: str,
    space: Mapping[str, Mapping[str, Sequence]],
    max_seconds: float = float("inf"),
) -> DataFrame:
    """M2: fit every classifier configuration on ``train``, score on ``test``;
    rows sorted by accuracy (ties: model, params)."""
    from traitlab.operators.classify import metrics as K
    from traitlab.operators.classify.models import FITTERS
    from traitlab.session import scratch_table

    spark = train.sparkSession
    rows = []
    start = time.monotonic()
    for model, pspace in space.items():
        for params in param_grid(pspace):
            if time.monotonic() - start > max_seconds:
                rows.append((model, json.dumps(params, sort_keys=True, default=str), None, None, None, None, None, "", 0.0, "skipped: time budget"))
                continue
            t0 = time.monotonic()
            fm = FITTERS[model](train, list(cols), y, params)
            has_prob = model != "SVM"
            pred = scratch_table(fm.transform(test, prob_prefix="prob_" if has_prob else None).withColumnRenamed(y, "_y").drop(*cols), "predictions")
            m = K.metrics_row(pred, fm.label_map, len(cols), y="_y", p="p", prob_prefix="prob_" if has_prob else None)
            rows.append((model, json.dumps(params, sort_keys=True, default=str), m["accuracy"], m["auc"], m["mse"], m["log_loss"], m["bic"], ",".join(fm.ignored_params), time.monotonic() - t0, None))
    schema = "model string, params string, accuracy double, auc double, mse double, log_loss double, bic double, ignored_params string, seconds double, error string"
    out = spark.createDataFrame(rows, schema)
    return out.orderBy(F.desc_nulls_last("accuracy"), "model", "params")


def best_by_accuracy(results: DataFrame) -> DataFrame:
    """M2: the best configuration (a top-1 is the feature)."""
    return results.filter(F.col("error").isNull()).orderBy(F.desc("accuracy"), "model", "params").limit(1)


def random_search(train: DataFrame, cols: Sequence[str], y: str, space: Mapping[str, Sequence], n_iter: int = 10, folds: int = 3, seed: int = 42, parallelism: int = 4, balanced: bool = True):
    """M3: seeded random sample of the random-forest grid, k-fold CV on
    accuracy (folds by det rank, ``foldCol``), refit of the best on all of
    ``train``.  Returns (best FittedModel, table of tried configurations).
    One kind of forest serves all folds and the refit: Spark ML's where it has
    all that the drawn configurations ask for, else the exact one, which keeps
    leaf and split bounds and any depth."""
    import random

    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from traitlab.operators.classify.models import _indexed, asks_exact, fit_forest, forest_features
    from traitlab.operators.features import assemble
    from traitlab.operators.sample import folds as make_folds

    grid = param_grid(space)
    rnd = random.Random(seed)
    picks = rnd.sample(grid, min(n_iter, len(grid)))
    if any(asks_exact(p) for p in picks):
        return _exact_search(train, list(cols), y, picks, folds, seed, balanced)
    from traitlab.operators.sample import class_weights

    data, _labels = _indexed(train, y)
    data = make_folds(data, _key_of(train), folds, stratify=y, seed=seed, out="_fold")
    if balanced:
        data = class_weights(data, y, out="_w")
    data = assemble(data, list(cols), "_features")
    rf = RandomForestClassifier(featuresCol="_features", labelCol="_label", seed=seed)
    if balanced:
        rf.setWeightCol("_w")
    maps = []
    for p in picks:
        depth = p.get("max_depth")
        maps.append(
            {
                rf.numTrees: int(p.get("n_estimators", 100)),
                rf.maxDepth: 30 if depth is None else min(int(depth), 30),
                rf.minInstancesPerNode: int(p.get("min_samples_leaf", 1)),
                rf.featureSubsetStrategy: forest_features(p.get("max_features", "sqrt")),
                rf.bootstrap: bool(p.get("bootstrap", True)),
            }
        )
    ev = MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy")
    cv = CrossValidator(estimator=rf, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, foldCol="_fold", parallelism=parallelism, seed=seed)
    cvm = cv.fit(data)
    best_i = max(range(len(picks)), key=lambda i: cvm.avgMetrics[i])
    if balanced:
        best = fit_forest(class_weights(train, y, out="_w"), list(cols), y, picks[best_i], weight="_w", seed=seed, exact=False)
    else:
        best = fit_forest(train, list(cols), y, picks[best_i], seed=seed, exact=False)
    return best, _tried(train.sparkSession, picks, cvm.avgMetrics)


def _tried(spark: SparkSession, picks: Sequence[dict], accuracies: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(json.dumps(p, sort_keys=True, default=str), float(m)) for p, m in zip(picks, accuracies)], "params string, cv_accuracy double")


def _exact_search(train: DataFrame, cols: list[str], y: str, picks: Sequence[dict], folds: int, seed: int, balanced: bool):
    """``random_search`` with exact forests: grown whole by tasks that hold the
    training table, or, where it is too large for that, by passes over it."""
    from traitlab.operators.classify import held as H
    from traitlab.operators.classify import metrics as K
    from traitlab.operators.classify.forest import grow_forest
    from traitlab.operators.classify.models import FOREST_PARAMS, FittedModel, checked_params, exact_settings
    from traitlab.operators.sample import class_weights
    from traitlab.operators.sample import folds as make_folds
    from traitlab.session import scratch_table

    spark, key = train.sparkSession, _key_of(train)
    picks = [checked_params("RandomForest", p, FOREST_PARAMS) for p in picks]
    settings = [exact_settings(p) for p in picks]
    # the draws go by key, label and features, as keys may be null or repeat
    rid = F.xxhash64(*dict.fromkeys([key, y, *cols])).alias("_rid")
    data = make_folds(train.where(F.col(y).isNotNull()).select("*", rid), key, folds, stratify=y, seed=seed, out="_fold")
    weight = "_w" if balanced else None
    if balanced:
        data = class_weights(data, y, out="_w")
    data = scratch_table(data.select(*dict.fromkeys([y, *cols]), "_rid", "_fold", *[weight] * balanced), "search-train")
    held = H.held_table(data, cols, y, "_rid", weight, "_fold")
    if held is not None:
        accuracies = H.cross_validated(spark, held, settings, seed)
    else:
        in_use = sorted(r[0] for r in data.select("_fold").distinct().collect())
        accuracies = []
        for s in settings:
            models = {f: grow_forest(data.where(F.col("_fold") != f), cols, y, key="_rid", weight=weight, seed=seed, **s) for f in in_use}
            of = [K.accuracy(m.transform(data.where(F.col("_fold") == f), prob_prefix=None), y, "p").first()["accuracy"] for f, m in models.items()]
            accuracies.append(float(np.mean(of)))
    best_i = max(range(len(picks)), key=lambda i: accuracies[i])
    if held is not None:
        forest = H.held_forest(spark, held, cols, settings[best_i], seed, train.schema[y].dataType)
    else:
        forest = grow_forest(data, cols, y, key="_rid", weight=weight, seed=seed, **settings[best_i])
    ignored = [k for k in picks[best_i] if k == "n_jobs" or (k == "class_weight" and not balanced)]
    best = FittedModel("RandomForest", forest, cols, forest.classes, picks[best_i], ignored)
    return best, _tried(spark, picks, accuracies)


def _key_of(df: DataFrame) -> str:
    for k in ("row_id", "vec_id", "id"):
        if k in df.columns:
            return k
    raise ValueError("random_search needs a row key column (row_id / vec_id)")


ASSIGNMENT_SCHEMA = T.StructType(
    [
        T.StructField("config_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("scaled", T.BooleanType()),
        T.StructField("n_clusters", T.IntegerType()),
        T.StructField("calinski_harabasz", T.DoubleType()),
        T.StructField("davies_bouldin", T.DoubleType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("n_clusters_found", T.LongType()),
        T.StructField("cluster_entropy", T.DoubleType()),
    ]
)


def assignment_grid(
    df: DataFrame,
    key: str,
    feature_sets: Mapping[str, Sequence[str]],
    ks: Sequence[int] = (3, 4),
    lloyd_steps: Sequence[int] = (0, 1),
    scaled: Sequence[bool] = (False, True),
) -> DataFrame:
    """A K-Means grid whose every fit SQL can reproduce: start from the first
    k rows by det, run 0 or 1 Lloyd updates, assign; metrics CH, DB, squared
    silhouette, clusters found and entropy.  Model names ``KMeans<steps>``."""
    from traitlab.operators.cluster.kmeans import init_first_rows
    from traitlab.operators.features import standardize
    from traitlab.session import scratch_table

    spark = df.sparkSession
    rows = []
    for data_type, cols in feature_sets.items():
        cols = list(cols)
        base = df.select(key, *cols)
        for sc in scaled:
            feats = scratch_table(standardize(base, cols)[0] if sc else base, "grid-features")
            batch = Batch.of(feats, cols)
            first = np.array(init_first_rows(feats, key, cols, max(ks)))
            asked = [(steps, k) for steps in lloyd_steps for k in ks]
            configs = [Config("KMeans", first[:k], max_iter=steps, tol=0.0) for steps, k in asked]
            batch.fit(configs)
            for (steps, k), q in zip(asked, batch.rate(configs)):
                model = f"KMeans{steps}"
                rows.append((f"{model}|{data_type}|{str(sc).lower()}|{k}", model, data_type, sc, k, q["calinski_harabasz"], q["davies_bouldin"], q["silhouette"], q["n_clusters_found"], q["cluster_entropy"]))
    return spark.createDataFrame(rows, ASSIGNMENT_SCHEMA)
