"""Queries for scoring new responses (R1-R3) and model persistence."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from traitlab.plans import flows
from traitlab.plans import oracle as O
from traitlab.plans.catalog import register
from traitlab.session import checkpoint_dir
from traitlab.sources.dims import ITEMS, SCORES
from traitlab.streaming import scoring as R


def _new_ctes(complete_only: bool):
    notnull = (" AND " + " AND ".join(f"{c} IS NOT NULL" for c in ITEMS)) if complete_only else ""
    z = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}_z" for c in SCORES)
    dist = " + ".join(f"(nz.{c}_z - lab_cen.c_{c}_z) * (nz.{c}_z - lab_cen.c_{c}_z)" for c in SCORES)
    return [
        O.zs_cte(),
        O.nearest_first_k_ctes("zs", O.ZSCORES, 5),
        f"nw AS (SELECT *, {O.score_exprs()} FROM num WHERE IPC = 2{notnull})",
        f"nz AS (SELECT nw.*, {z} FROM nw JOIN zs_stats ON TRUE)",
        f"nd AS (SELECT nz.row_id, lab_cen.cid, {dist} AS d FROM nz JOIN lab_cen ON TRUE)",
        "nl AS (SELECT row_id, CAST(cid AS INTEGER) AS cluster FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, cid) AS rn FROM nd) t WHERE rn = 1)",
    ]


def _r01_sql():
    return O.with_clean(*_new_ctes(True)) + "SELECT row_id, cluster FROM nl"


@register("r01_score_batch", _r01_sql)
def r01_score_batch(spark, sf_dir):
    model = flows.cluster_model(spark, sf_dir)
    return R.score_batch(model, flows.new_responses(spark, sf_dir)).select("row_id", "cluster")


def _r03_sql():
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ITEMS)
    return O.with_clean(*_new_ctes(False)) + (
        f"SELECT nw.row_id, CASE WHEN ({n}) = 50 THEN nl.cluster END AS cluster, "
        f"CASE WHEN ({n}) < 50 THEN printf('incomplete response: %d of %d answers', CAST({n} AS INTEGER), 50) END AS error "
        "FROM nw JOIN nl ON nw.row_id = nl.row_id"
    )


@register("r03_score_safe", _r03_sql)
def r03_score_safe(spark, sf_dir):
    model = flows.cluster_model(spark, sf_dir)
    return R.score_safe(model, flows.new_responses(spark, sf_dir, complete_only=False), ITEMS).select("row_id", "cluster", "error")


@register("r02_score_stream", _r01_sql)
def r02_score_stream(spark, sf_dir):
    """The new responses land as Parquet files in a source folder
    under spark.checkpoint.dir; a Structured Streaming query (availableNow)
    scores them into a Parquet sink, which is read back.  Equals r01."""
    base = f"{checkpoint_dir(spark)}/r02-{uuid.uuid4().hex}"
    model = flows.cluster_model(spark, sf_dir)
    saved = f"{base}/model"
    model.save(spark, saved)
    model = R.ClusterScorer.load(spark, saved)
    arriving = flows.new_responses(spark, sf_dir)
    arriving.write.parquet(f"{base}/in")
    q = R.score_stream(spark, model, f"{base}/in", arriving.schema, f"{base}/out", checkpoint=f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("row_id", "cluster")


__all__ = ["F"]
