"""Connected components of a link table, as rounds of joins and aggregates.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round links each node's larger
neighbours to its smallest one, then each node and its smaller neighbours to
the smallest of them.  Rounds grow with the logarithm of the longest chain.
Links stay in Spark; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.session import materialize, release

MAX_ROUNDS = 64
HOT_DEGREE = 256
MOST_HOT = 10_000  # nodes


def _with_minimum(edges: DataFrame, lowest: DataFrame, size: int) -> DataFrame:
    """``edges(a, b)`` with ``m`` from ``lowest(a, m, degree)``.

    A node with a large share of the links would put them all into one task of
    a join.  At most ``size / least`` nodes have ``least`` links or more, so these
    few are broadcast, whatever the table's size, and the others joined.
    """
    least = max(HOT_DEGREE, size // MOST_HOT)
    hot, cold = F.broadcast(lowest.filter(F.col("degree") >= least).select("a", "m")), lowest.filter(F.col("degree") < least).select("a", "m")
    return edges.join(hot, "a").unionByName(edges.join(hot.select("a"), "a", "left_anti").join(cold, "a"))


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))


def _large_star(edges: DataFrame, size: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = _lowest(both).select("a", F.least("a", "m").alias("m"), "degree")
    return _with_minimum(both, lowest, 2 * size).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Links come as stars around smallest ids, so a node with many smaller neighbours is rare; AQE splits its rows.
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = _lowest(down).select("a", "m")
    linked = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(lowest.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of longs -> stored ``(id, component)``.

    Holds every id that occurs in a link between two different ids;
    ``component`` is the smallest id reachable.  Null ends are dropped,
    repeated links and self links change nothing, an empty table gives an
    empty one.
    """
    edges = materialize(
        links.select(F.col("a").cast("long"), F.col("b").cast("long"))
        .filter("a is not null and b is not null and a <> b")
        .distinct()
    )
    checksum = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    for _ in range(MAX_ROUNDS):
        after = edges.agg(*checksum).first()
        if after[0] == 0 or after == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before, old = after, edges
        edges = materialize(_small_star(_large_star(old, after[0])))
        release(old)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
