"""Segmented scans: running sums, totals and minima that start anew in every group (WIN-4, REA-3..5).

A window per group puts a group that holds a third of all rows into one task.
Here rows are range-partitioned on ``(group, order)`` and stored, so a large
group spans many partitions.  Windows then run inside ``(partition, group)``,
and what a group has in its other partitions is carried over: only the first
and the last group of a partition can reach beyond it, so the carry table has
at most two rows a partition and is broadcast.  Nothing is joined on the group
itself.

Several scans over nested groups share the one sort: ``("user",)`` and
``("user", "time")`` both read rows in the order of user, time and the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.operators.indexing import _num_partitions
from eventsieve.session import materialize

_PART = "_scan_part"


@dataclass(frozen=True)
class Scan:
    """What to compute within ``group``; every mapping is output column -> input column."""

    group: tuple[str, ...]
    running: dict[str, str] = field(default_factory=dict)  # sums up to and with the row
    totals: dict[str, str] = field(default_factory=dict)  # sums over the whole group
    lows: dict[str, str] = field(default_factory=dict)  # minima over the whole group

    def outputs(self) -> list[str]:
        return [*self.running, *self.totals, *self.lows]


def _carried(ranged: DataFrame, ends: DataFrame, scan: Scan, level: int) -> DataFrame:
    """What the groups at the partitions' edges have elsewhere: ``(part, group, before_*, all_*)``."""
    edge = ranged.join(F.broadcast(ends), _PART).filter(_same(scan.group, "_lo") | _same(scan.group, "_hi"))
    sums = [F.sum(c).alias(o) for o, c in (scan.running | scan.totals).items()]
    lows = [F.min(c).alias(o) for o, c in scan.lows.items()]
    parts = edge.groupBy(F.col(_PART).alias(f"_p{level}"), *[F.col(g).alias(f"_g{level}_{g}") for g in scan.group]).agg(*sums, *lows)
    names = [f"_g{level}_{g}" for g in scan.group]
    before = Window.partitionBy(*names).orderBy(f"_p{level}").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*names)
    return parts.select(
        f"_p{level}", *names,
        *[F.coalesce(F.sum(o).over(before), F.lit(0)).alias(f"_before_{o}") for o in scan.running],
        *[F.sum(o).over(every).alias(f"_all_{o}") for o in scan.totals],
        *[F.min(o).over(every).alias(f"_all_{o}") for o in scan.lows],
    )


def _same(group: Sequence[str], end: str) -> Column:
    out = F.lit(True)
    for g in group:
        out = out & F.col(g).eqNullSafe(F.col(f"{end}.{g}"))
    return out


def segmented_scan(df: DataFrame, group: Sequence[str], order_by: Sequence[Column], scans: Sequence[Scan], num_partitions: int | None = None) -> DataFrame:
    """``df`` with the outputs of ``scans``, in any row order.

    Rows are read by ``group`` (ascending, null first), then ``order_by``,
    which must tell all rows of a group apart.  Each scan's group is a leading
    part of ``group``; a null group is a group.  Sums of no rows do not occur; a
    minimum over nulls alone is null.  An empty frame gives an empty one.
    """
    group = list(group)
    for scan in scans:
        if list(scan.group) != group[: len(scan.group)] or not scan.group:
            raise ValueError(f"{scan.group} is no leading part of {group}")
    order = [F.col(g).asc_nulls_first() for g in group] + list(order_by)
    parts = _num_partitions(df, num_partitions)
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn(_PART, F.spark_partition_id()))
    ends = ranged.groupBy(_PART).agg(F.min(F.struct(*group)).alias("_lo"), F.max(F.struct(*group)).alias("_hi"))
    shortest = min((scan.group for scan in scans), key=len)
    out = ranged.repartition(_PART, *shortest)  # serves the windows of all scans
    for scan in scans:
        own = [_PART, *scan.group]
        ordered = Window.partitionBy(*own).orderBy(*order[len(scan.group) :])
        up_to, every = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = out.withColumns(
            {f"_here_{o}": F.sum(c).over(up_to) for o, c in scan.running.items()}
            | {f"_here_{o}": F.sum(c).over(every) for o, c in scan.totals.items()}
            | {f"_here_{o}": F.min(c).over(every) for o, c in scan.lows.items()}
        )
    finals: dict[str, Column] = {}
    for level, scan in enumerate(scans):
        match = F.col(_PART) == F.col(f"_p{level}")
        for g in scan.group:
            match = match & F.col(g).eqNullSafe(F.col(f"_g{level}_{g}"))
        out = out.join(F.broadcast(_carried(ranged, ends, scan, level)), match, "left")
        finals |= {o: F.coalesce(F.col(f"_before_{o}"), F.lit(0)) + F.col(f"_here_{o}") for o in scan.running}
        finals |= {o: F.coalesce(F.col(f"_all_{o}"), F.col(f"_here_{o}")) for o in [*scan.totals, *scan.lows]}
    return out.select(*df.columns, *[c.alias(o) for o, c in finals.items()])
