"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.session import scratch_table

#: rows up to which the table of minima is broadcast
BROADCAST_ROWS = 200_000


def _side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def min_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(v, root) for every node that has an edge to another; root is the
    smallest node it can reach.

    An edge is kept as (high, low).  A round first hangs every node's higher
    neighbours on its least neighbour, then every node's lower neighbours on
    the least of them; both keep what is connected, and when no edge changes
    each component is a star around its least node.  Minima are aggregates
    with partial sums; the edges meet them in joins whose hot keys AQE splits,
    or by broadcast while they are few.  Each round is a written table."""
    low, high = F.least(a, b), F.greatest(a, b)
    links = scratch_table(edges.where(F.col(a) != F.col(b)).select(high.alias("hi"), low.alias("lo")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        around = links.select(F.col("hi").alias("v"), F.col("lo").alias("u")).unionByName(links.select(F.col("lo").alias("v"), F.col("hi").alias("u")))
        least = scratch_table(around.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")), "minima")
        up = scratch_table(links.join(_side(least), F.col("lo") == F.col("v")).select("hi", F.col("m").alias("lo")).unionByName(links.select("hi", "lo").join(_side(least), F.col("hi") == F.col("v")).select("hi", F.col("m").alias("lo"))).where("hi != lo").distinct(), "up")
        down = scratch_table(up.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("m")), "down")
        moved = up.join(_side(down), F.col("hi") == F.col("v")).where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = scratch_table(moved.unionByName(down.select(F.col("v").alias("hi"), F.col("m").alias("lo"))).distinct(), "links")
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    both = links.select(F.col("hi").alias("v"), F.col("lo").alias("root")).unionByName(links.select(F.col("lo").alias("v"), F.col("lo").alias("root")))
    return both.groupBy("v").agg(F.min("root").alias("root"))
