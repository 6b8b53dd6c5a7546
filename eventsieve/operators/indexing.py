"""Global row position without a single-task window (WIN-1 at scale).

``row_number() OVER (ORDER BY ...)`` with no partition key moves every row to
one task.  Here the rows are range-partitioned on the sort key, sorted inside
each partition, and numbered in three steps:

1. ``monotonically_increasing_id`` on the sorted partitions gives
   ``partition_index << 33 | position_in_partition``;
2. per-partition row counts (one row per partition) are prefix-summed;
3. the offsets (bounded by the partition count, so broadcast is safe) are
   joined back and added to the local position.

The numbered frame is stored once (parquet under the checkpoint folder) so
both consumers see the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.session import materialize

_LOCAL_BITS = 33
RANGE_BYTES = 256 << 20
UNKNOWN_BYTES = 1 << 55


def _num_partitions(df: DataFrame, requested: int | None) -> int:
    """At least ``spark.sql.shuffle.partitions``; more where the tables read would give larger ranges.

    The sizes of the plan's leaves are summed: the planner's estimate of the
    whole multiplies the sides of a join."""
    if requested:
        return requested
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    # A leaf of unknown size says "as large as can be", which tells nothing.
    return max(least, -(-sum(s for s in sizes if s < UNKNOWN_BYTES) // RANGE_BYTES))


def broadcast_if_small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """Hint a broadcast only after counting: beyond ``rows`` rows the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_global_index(
    df: DataFrame,
    order_by: list[Column],
    index_col: str = "row_index",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a zero-based ``index_col`` following ``order_by`` (a total order).

    ``order_by`` must break all ties (end with a unique key) so that the
    result, and any recomputation after a lost executor, is deterministic.
    """
    parts = _num_partitions(df, num_partitions)
    ranged = (
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_mono", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mono", _LOCAL_BITS))
        .withColumn("_local", F.col("_mono").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_mono")
    )
    # Store the numbered rows once: both consumers (counts and the final
    # join) read the same stored _pid/_local, and a lost executor re-reads
    # the table instead of recomputing ids.
    ranged = materialize(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-task window here is bounded by `parts`.
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(index_col, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_pid", "_local", "_offset")
    )


def with_rank_within(
    df: DataFrame,
    group_col: str,
    order_by: list[Column],
    rank_col: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Zero-based position inside each ``group_col`` value.

    Same result as ``row_number() OVER (PARTITION BY g ORDER BY ...) - 1``,
    but a group holding a large share of the rows is ranked by many tasks: a
    segmented scan counts the rows before, and nothing is joined on the group.
    A null group is a group."""
    from eventsieve.operators.scan import Scan, segmented_scan

    one = df.withColumn("_one", F.lit(1).cast("long"))
    ranked = segmented_scan(one, (group_col,), order_by, [Scan((group_col,), running={rank_col: "_one"})], num_partitions)
    return ranked.withColumn(rank_col, F.col(rank_col) - 1).drop("_one")
