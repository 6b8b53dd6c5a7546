"""Tables for lookups by user and by event id (SNK-3).

The reference's store has an index on each of the two keys.  Here a table is
bucketed on the user: a filter on users reads only their buckets, and a join on
the user needs no exchange of the table.  Inside a bucket rows are sorted by
event id and every file carries a Bloom filter of its ids: a filter on ids
skips the row groups that cannot hold them.

A user with a large share of the rows makes one large bucket; AQE writes it as
several files from several tasks (``REBALANCE``).  Key sets that are counted
small are broadcast, so that such a bucket is read split by split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.operators.indexing import broadcast_if_small
from eventsieve.session import delete_path

BUCKETS = 16
BUCKET_ROWS = 4_000_000
# Parquet gets a list of more values than this as a range only, which Bloom filters cannot use.
PUSHED_VALUES = 10


def buckets_for(rows: int) -> int:
    """Buckets of a table of ``rows`` rows: a power of two, so that tables of different size still divide each other."""
    return max(BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


def any_of(column: str, keys: Sequence[str]) -> Column:
    """``column IN keys`` in lists short enough to be pushed down value by value."""
    lists = [F.col(column).isin(list(keys[i : i + PUSHED_VALUES])) for i in range(0, len(keys), PUSHED_VALUES)]
    return reduce(lambda a, b: a | b, lists, F.lit(False))


@dataclass(frozen=True)
class LookupTable:
    """A table bucketed on ``user_col`` with Bloom filters on ``id_col``."""

    name: str
    path: str
    user_col: str
    id_col: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def of_users(self, spark: SparkSession, users: Sequence[str]) -> DataFrame:
        """Rows of some users: only their buckets are read."""
        return self.read(spark).filter(F.col(self.user_col).isin(list(users)))

    def of_ids(self, spark: SparkSession, ids: Sequence[str]) -> DataFrame:
        """Rows of some event ids: row groups are skipped by their ranges and Bloom filters."""
        return self.read(spark).filter(any_of(self.id_col, ids))

    def matching(self, keys: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` stands in the frame ``keys(column)``, however many keys there are.

        On the user column the table's buckets serve as its partitioning.
        """
        keys = keys.select(column).distinct()
        return self.read(keys.sparkSession).join(broadcast_if_small(keys), column, "left_semi")

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(spark, self.path)


def save_lookup_table(df: DataFrame, name: str, path: str, rows: int, user_col: str = "target_user_id", id_col: str = "event_id") -> LookupTable:
    """Replace the table ``name`` at ``path``; ``rows`` (as measured) sets buckets and the Bloom filters' size."""
    buckets = buckets_for(rows)
    (
        df.hint("rebalance", buckets, user_col)
        .write.mode("overwrite")
        .bucketBy(buckets, user_col)
        .sortBy(id_col)
        .option("path", path)
        .option(f"parquet.bloom.filter.enabled#{id_col}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{id_col}", str(max(1000, -(-rows // buckets))))
        .saveAsTable(name)
    )
    return LookupTable(name, path, user_col, id_col)
