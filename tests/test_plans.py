"""Physical-plan properties that matter at scale: column pruning and filter
pushdown reach the Parquet scan, bounded broadcasts, no cartesian products."""

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_histogram_reads_only_needed_columns(spark, sf_small):
    p = plan(entry.queries()["a05_histogram_lineitem"](spark, sf_small))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "ReadSchema" in line]
    text = " ".join(scan)
    assert "l_quantity" in text and "l_orderkey" not in text and "l_shipdate" not in text


def test_filter_pushed_to_scan(spark, sf_small):
    from pyspark.sql import functions as F

    ev = spark.read.parquet(f"{sf_small}/events.parquet").filter(F.col("event_type") == "click").select("user_id")
    p = plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p


def test_no_cartesian_products_in_registered_plans(spark, sf_small):
    qs = entry.queries()
    for name in ["a01_cluster_profile", "b04_stratified_split", "e08_eps_pairs", "k02_auc_ovr", "c10_davies_bouldin", "a06_answer_histogram"]:
        p = plan(qs[name](spark, sf_small))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_dimension_join_is_broadcast(spark, sf_small):
    p = plan(entry.queries()["e01_join_country"](spark, sf_small))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
