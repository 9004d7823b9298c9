"""End-to-end supervised workflows (L11-L13), each a sequence of the
operators above; every data step is a Spark job over the whole input."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.columns import text_label, us_region
from traitlab.operators import sample as B
from traitlab.operators.classify import metrics as K
from traitlab.operators.classify import models as L
from traitlab.operators.enrich import fold_rare, join_country
from traitlab.operators.features import standardize
from traitlab.session import scratch_table
from traitlab.sources.dims import ITEMS, SCORES

# The US-region forest of the reference.
US_FOREST = {"n_estimators": 188, "max_depth": 30, "max_features": "sqrt", "max_leaf_nodes": 100, "min_samples_leaf": 2, "min_samples_split": 7, "class_weight": "balanced"}

# Random-search space of the location model.
LOCATION_SPACE = {
    "n_estimators": [150, 200, 250, 300],
    "max_depth": [20, 30, 40, 50, None],
    "max_features": ["sqrt", "log2", 0.3, 0.7],
    "min_samples_split": [2, 5, 10, 15],
    "min_samples_leaf": [1, 2, 4, 6],
    "max_leaf_nodes": [None, 50, 100],
    "bootstrap": [True, False],
}


def us_region_model(df: DataFrame, key: str = "row_id", lat: str = "lat", lon: str = "lon", country: str = "country"):
    """US responses -> region from coordinates -> features (everything
    but coordinates, country, region, dateload, IPC) -> label encoding ->
    standardise (fit on all rows) -> 80/20 split -> largest class cut to the
    second largest -> balanced weights -> fixed random forest -> report."""
    # a small part of the responses: written once, not cut out of them again by every later step
    us = scratch_table(df.filter(F.upper(F.col(country)) == "US").withColumn("region", us_region(lat, lon)), "us-responses")
    drop = {lat, lon, country, "region", "dateload", "IPC", key}
    feats = [c for c, t in us.dtypes if c not in drop and t in ("double", "int", "bigint", "float")]
    z, _sc = standardize(us, feats)
    sp = scratch_table(B.split(z, key, 0.2), "us-split")
    train = B.level_largest(sp.filter(F.col("split") == "train"), "region", key)
    train = B.class_weights(train, "region", out="w")
    test = sp.filter(F.col("split") == "test")
    model = L.fit_forest(train, feats, "region", US_FOREST, weight="w", key=key)
    pred = model.transform(test, prob_prefix=None)
    return model, K.class_report(pred, y="region", p="p")


def location_model(df: DataFrame, dim: DataFrame, target: str = "region", key: str = "row_id", min_count: int = 5000, sample_frac: float = 0.6, n_iter: int = 10, folds: int = 3):
    """Join country data -> fold rare countries into their region ->
    sample -> answers as features -> text label -> standardise (fit before
    the split) -> stratified split -> cap 10 000 per class -> balanced
    weights -> random search with k-fold CV -> evaluation row."""
    from traitlab.operators.search import random_search

    j = join_country(df, dim)
    j = fold_rare(j, "country", "region", min_count=min_count)
    j = scratch_table(B.sample_frac(j, key, sample_frac), "location-sample")
    feats = [c for c in j.columns if c[:3] in ("EXT", "AGR", "CSN", "OPN", "EST") and len(c) <= 5]
    j = j.withColumn("y", text_label(target))
    z, _sc = standardize(j, feats)
    sp = scratch_table(B.split(z, key, 0.2, stratify="y"), "location-split")
    train = B.cap_classes(sp.filter(F.col("split") == "train"), "y", key, cap=10_000)
    test = sp.filter(F.col("split") == "test")
    best, tried = random_search(train, feats, "y", LOCATION_SPACE, n_iter=n_iter, folds=folds)
    pred = scratch_table(best.transform(test, prob_prefix=None).select("y", "p"), "predictions")
    prf = K.weighted_prf(pred, y="y", p="p")
    acc = K.accuracy(pred, y="y", p="p")
    summ = K.prediction_summary(pred, y="y", p="p")
    r = {**acc.first().asDict(), **prf.first().asDict(), **summ.first().asDict()}
    row = (r["accuracy"], r["f1"], r["precision"], r["recall"], int(r["n_true_classes"]), str(r["top_class"]), r["pred_distribution"], json.dumps(best.params, default=str))
    spark = df.sparkSession
    schema = "accuracy double, f1_score double, precision double, recall double, n_classes bigint, top_predicted_class string, class_distribution string, best_params string"
    return best, spark.createDataFrame([row], schema), tried


def cluster_membership_model(df: DataFrame, cols: Sequence[str], y: str, key: str = "row_id", n: int = 10_000, space: dict | None = None):
    """80/20 split -> at most n training rows (a bound on the fit; all
    test rows are scored) -> standardise on train, apply to test -> classifier
    grid -> results sorted by accuracy (best first)."""
    from traitlab.operators.search import classifier_grid

    sp = B.split(df, key, 0.2)
    train, test = B.sample_n(sp.filter(F.col("split") == "train"), key, n), sp.filter(F.col("split") == "test")
    train, test, _sc = standardize(train, list(cols), test)
    space = space or {"LogisticRegression": {"C": [0.1, 1.0], "max_iter": [100]}, "RandomForest": {"n_estimators": [50], "max_depth": [10]}}
    return classifier_grid(train, test, list(cols), y, space)


__all__ = ["ITEMS", "SCORES"]
