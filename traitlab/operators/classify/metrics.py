"""Classifier metrics (K1-K9) as Spark aggregations over a predictions table
(``y`` true label, ``p`` predicted label, optional ``prob_<class>`` columns).

All metrics reduce to counts per (y, p) or per (class, score) and are
computed with partial aggregation; the AUC prefix sums are taken over
range-sorted scores, so no task sorts all scores of a class."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.operators.ordered import running_sums

EPS = 1e-15


def accuracy(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K1."""
    return pred.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def mse(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K3: mean squared difference of the label codes."""
    d = F.col(y).cast("double") - F.col(p).cast("double")
    return pred.agg(F.avg(d * d).alias("mse"))


def _prob_of_true(classes: Sequence, y: str, prob_prefix: str):
    expr = None
    for c in classes:
        cond = F.col(y) == F.lit(c)
        expr = F.when(cond, F.col(f"{prob_prefix}{c}")) if expr is None else expr.when(cond, F.col(f"{prob_prefix}{c}"))
    return expr


def log_loss(pred: DataFrame, classes: Sequence, y: str = "y", prob_prefix: str = "prob_", eps: float = EPS) -> DataFrame:
    """K4: mean of -ln(max(p_true, eps))."""
    pt = _prob_of_true(classes, y, prob_prefix)
    return pred.agg(F.avg(-F.log(F.greatest(pt, F.lit(eps)))).alias("log_loss"))


def bic(pred: DataFrame, classes: Sequence, n_features: int, y: str = "y", prob_prefix: str = "prob_") -> DataFrame:
    """K5: log_loss * n + k * ln(n), k = number of features (no factor 2)."""
    pt = _prob_of_true(classes, y, prob_prefix)
    agg = pred.agg(F.avg(-F.log(F.greatest(pt, F.lit(EPS)))).alias("ll"), F.count(F.lit(1)).alias("n"))
    return agg.select((F.col("ll") * F.col("n") + F.lit(float(n_features)) * F.log("n")).alias("bic"))


def auc_ovr(pred: DataFrame, classes: Sequence, y: str = "y", prob_prefix: str = "prob_") -> DataFrame:
    """K2: one-vs-rest macro AUC with mid-ranks for tied scores.

    AUC_c = sum over positives of (#negatives below + half the tied
    negatives) / (P * N).  Counts are aggregated per (class, distinct score);
    the negatives below are running sums over range-sorted scores, so scores
    that crowd in one place are still dealt over the tasks."""
    long = pred.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("cls"), F.col(f"{prob_prefix}{c}").alias("score"), (F.col(y) == F.lit(c)).alias("pos")) for c in classes])).alias("e")
    ).select("e.*")
    g = long.groupBy("cls", "score").agg(F.count_if("pos").alias("np"), F.count_if(~F.col("pos")).alias("nn"))
    g = running_sums(g, ["cls"], ["score"], "nn", "upto").withColumn("below", F.col("upto") - F.col("nn"))
    per = g.groupBy("cls").agg(
        F.sum(F.col("np") * (F.col("below") + F.col("nn") * F.lit(0.5))).alias("s"),
        F.sum("np").alias("P"),
        F.sum("nn").alias("N"),
    )
    per = per.filter((F.col("P") > 0) & (F.col("N") > 0)).withColumn("auc", F.col("s") / (F.col("P") * F.col("N")))
    return per.agg(F.avg("auc").alias("auc_ovr"))


def confusion(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K8 (long form): count per (true, predicted)."""
    return pred.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_wide(pred: DataFrame, classes: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """K8: rows = true class, one column per predicted class (explicit list)."""
    return pred.groupBy(y).pivot(p, list(classes)).count().na.fill(0)


def per_class(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per class: support, predicted count, true positives, precision, recall, f1.
    Classes are those seen as truth or as prediction.  One scan of the
    predictions; every confusion count goes to its true and its predicted
    class, summed there."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("y").eqNullSafe(F.col("p")), n).otherwise(zero)
    both = F.array(
        F.struct(F.col("y").alias("cls"), n.alias("support"), zero.alias("npred"), hit.alias("tp")),
        F.struct(F.col("p").alias("cls"), zero.alias("support"), n.alias("npred"), zero.alias("tp")),
    )
    sums = confusion(pred, y, p).select(F.explode(both).alias("c")).select("c.*").groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "npred", "tp")])
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = sums.withColumns({"precision": share(F.col("tp"), F.col("npred")), "recall": share(F.col("tp"), F.col("support"))})
    return out.withColumn("f1", share(F.col("precision") * F.col("recall") * 2.0, F.col("precision") + F.col("recall")))


def weighted_prf(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K6: support-weighted precision, recall and F1."""
    pc = per_class(pred, y, p)
    tot = F.sum("support")
    return pc.agg(
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
    )


def class_report(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K7: per-class rows plus 'accuracy', 'macro avg' and 'weighted avg'.
    The per-class table (one row per class) is written once; the three rows
    are aggregates of it."""
    from traitlab.session import scratch_table

    per = scratch_table(per_class(pred, y, p), "per-class")
    three = ["precision", "recall", "f1"]
    tot = F.sum("support")
    sums = per.agg(
        tot.alias("support"),
        (F.sum("tp") / tot).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in three],
        *[(F.sum(F.col(c) * F.col("support")) / tot).alias(f"weighted_{c}") for c in three],
    ).where(F.col("support") > 0)
    none = F.lit(None).cast("double")
    line = lambda name, *v: F.struct(F.lit(name).alias("label"), *[x.alias(c) for x, c in zip(v, three)], F.col("support"))
    extra = F.array(
        line("accuracy", none, none, F.col("accuracy")),
        line("macro avg", *[F.col(f"macro_{c}") for c in three]),
        line("weighted avg", *[F.col(f"weighted_{c}") for c in three]),
    )
    rows = per.select(F.coalesce(F.col("cls").cast("string"), F.lit("None")).alias("label"), *three, "support")
    return rows.unionByName(sums.select(F.explode(extra).alias("r")).select("r.*"))


def prediction_summary(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """K9: predicted-class distribution as JSON, top predicted class (ties:
    smallest label), number of true classes."""
    dist = pred.groupBy(F.col(p).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    summary = dist.agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("cls").cast("string"), "n"))))).alias("pred_distribution"),
        F.min_by("cls", F.struct(-F.col("n"), F.col("cls"))).alias("top_class"),
        F.count(F.lit(1)).alias("n_pred_classes"),
    )
    ntrue = pred.agg(F.count_distinct(y).alias("n_true_classes"))
    return _side_by_side(summary, ntrue)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row (tagged union + one more aggregate;
    no join)."""
    cols_a, cols_b = a.columns, b.columns
    u = a.select(*cols_a, *[F.lit(None).alias(c) for c in cols_b]).unionByName(b.select(*[F.lit(None).alias(c) for c in cols_a], *cols_b), allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols_a + cols_b])


def metrics_row(pred: DataFrame, classes: Sequence, n_features: int, y: str = "y", p: str = "p", prob_prefix: str | None = "prob_") -> dict:
    """Driver-side convenience: the usual metrics row of a classifier run."""
    out = {
        "accuracy": accuracy(pred, y, p).first()[0],
        "mse": mse(pred, y, p).first()[0],
    }
    if prob_prefix:
        out["auc"] = auc_ovr(pred, classes, y, prob_prefix).first()[0]
        out["log_loss"] = log_loss(pred, classes, y, prob_prefix).first()[0]
        out["bic"] = bic(pred, classes, n_features, y, prob_prefix).first()[0]
    else:
        out.update({"auc": None, "log_loss": None, "bic": None})
    if out.get("bic") is not None and math.isnan(out["bic"]):
        out["bic"] = None
    return out
