"""Session construction, the shared checkpoint folder and stored tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every job relies on.  AQE re-plans joins and aggregates at run
# time: it coalesces small shuffle partitions, splits skewed ones and turns a
# sort-merge join into a broadcast join only when the measured side is small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "eventsieve", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _single_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    A folder the caller registered with ``setCheckpointDir`` comes first, then
    ``spark.checkpoint.dir``.  Only on a single-machine master, and only when
    both are unset (as in tests), a scratch folder is created; on a cluster an
    unset folder is an error, since executors would write to their own disks.
    """
    registered = spark.sparkContext.getCheckpointDir()
    if registered:
        return registered
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not _single_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="eventsieve-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str = "table") -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Paths of the copies stored by this driver and not yet deleted.
_STORED: list[str] = []


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage before several jobs read the same frame.

    The frame is written as a parquet table under the shared checkpoint
    folder and read back: later jobs, and any recomputation after a lost
    executor, start from the stored table with columnar reads and column
    pruning instead of re-running windows and shuffles.  Never
    ``localCheckpoint``.  ``release`` deletes the stored copy."""
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.mode("overwrite").parquet(path)
    return stored_table(spark, path, df.schema)


def stored_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The frame written as parquet to ``path``, which ``release`` deletes."""
    _STORED.append(path)
    stored = spark.read.schema(schema).parquet(path)
    stored._stored_path = path
    return stored


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, wherever it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(*stored: DataFrame) -> None:
    """Delete stored copies that no later job reads."""
    for df in stored:
        path = getattr(df, "_stored_path", None)
        if path in _STORED:
            _STORED.remove(path)
            delete_path(df.sparkSession, path)


@contextmanager
def only_result(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that stores a frame; on leaving, all other copies stored inside are deleted.

    An operator that needs stored steps returns its result through it, so that
    only what the caller reads stays behind; after an error nothing does.
    """
    before, kept = set(_STORED), []

    def keep(df: DataFrame) -> DataFrame:
        stored = materialize(df)
        kept.append(stored._stored_path)
        return stored

    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        for path in [p for p in _STORED if p not in before and p not in kept]:
            _STORED.remove(path)
            delete_path(spark, path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving all copies stored inside; results must have been written by then."""
    before = set(_STORED)
    try:
        yield
    finally:
        for path in [p for p in _STORED if p not in before]:
            _STORED.remove(path)
            delete_path(spark, path)
