"""REA-3 and REA-5 on a stream: keyed state with event-time timers.

Events come in any order within the watermark's delay.  A user's state holds
the events the watermark has not reached yet, the counts of all events before
them, and the times of the trailing window.  A timer at the first waiting
event fires when the watermark passes it: nothing at or before the watermark
can come any more, so the events up to it are taken in order of time and id, and
their rows are the batch operator's.  Rows that come later than the watermark are dropped by Spark
and counted in its progress (``late_rows``).

State is bounded by the delay and the window, per user; it lives in RocksDB
below the stream's checkpoint, which must be on the shared folder, and a
restarted query goes on from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventsieve.config import DEFAULT_RULES, RuleConfig
from eventsieve.functions.timestamps import epoch_micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "user_id long, event_id long, interaction_velocity_5m long, historical_report_rate double"


class UserHistory(StatefulProcessor):
    """One user's events in order of time and id."""

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "us array<bigint>, id array<bigint>, flag array<bigint>")
        self.past = handle.getValueState("past", "n bigint, reports bigint, us array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [list(x) for x in self.waiting.get()] if self.waiting.exists() else [[], [], []]
        earliest = None
        for batch in rows:
            for column, name in zip(held, ("us", "event_id", "flag"), strict=True):
                column += [int(x) for x in batch[name]]
            earliest = min(int(batch["us"].min()), earliest if earliest is not None else int(batch["us"].min()))
        self.waiting.update(tuple(held))
        self._wake(earliest)
        return iter(())

    def _wake(self, us: int) -> None:
        """A timer for the first millisecond not before the event."""
        self.handle.registerTimer(-(-us // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Rows at or before the watermark are late from now on; all others may still get peers.
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.waiting.exists():
            return
        events = sorted(zip(*self.waiting.get(), strict=True))
        ready, later = [e for e in events if e[0] <= limit], [e for e in events if e[0] > limit]
        if not ready:
            return
        if later:
            self.waiting.update(tuple(map(list, zip(*later, strict=True))))
            self._wake(later[0][0])
        else:
            self.waiting.clear()
        n, reports, recent = self.past.get() if self.past.exists() else (0, 0, [])
        recent = [*recent, *(us for us, _, _ in ready)]  # ascending
        out, first, end = [], 0, 0
        for us, event_id, flag in ready:
            while recent[first] < us - self.window_us:
                first += 1
            while end < len(recent) and recent[end] <= us:  # peers of one time count each other
                end += 1
            out.append((None if key[0] else key[1], event_id, end - first, reports / n if n else 0.0))
            n, reports = n + 1, reports + flag
        self.past.update((n, reports, [us for us in recent if us >= ready[-1][0] - self.window_us]))
        made = pd.DataFrame(out, columns=[c.split()[0] for c in OUTPUT.split(", ")])
        yield made.astype({"user_id": "Int64"})


def history_stream(events: DataFrame, report_flag: Column, watermark: str = "10 minutes", rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Streaming ``events(event_id, ts, user_id, ...)`` to ``OUTPUT``, a row per event once the watermark passes it.

    ``event_id`` tells events apart.  Events without a time have no place on a stream and are left out; a null
    user is one user.  The session's state store must be RocksDB (``use_rocksdb``).
    """
    timed = events.filter(F.col("ts").isNotNull()).select(
        # Keys are not null on their way to Python: a null user is marked.
        F.col("user_id").isNull().alias("no_user"), F.coalesce(F.col("user_id").cast("long"), F.lit(0)).alias("user"), F.col("event_id").cast("long").alias("event_id"), epoch_micros("ts").alias("us"),
        F.coalesce(report_flag.cast("long"), F.lit(0)).alias("flag"),
    )
    # The watermark's clock counts the same microseconds as the state, whatever the session's zone.
    timed = timed.withColumn("event_time", F.timestamp_micros("us")).withWatermark("event_time", watermark)
    return timed.groupBy("no_user", "user").transformWithStateInPandas(
        statefulProcessor=UserHistory(rules.velocity_window_seconds * 1_000_000), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )


def use_rocksdb(spark) -> None:
    """Keep the state of streams that start from now on in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def start_history_stream(spark, source_dir: str, output_dir: str, checkpoint_location: str, report_flag: Column, watermark: str = "10 minutes", files_per_batch: int | None = None):
    """Start over the parquet files in ``source_dir`` and take all of them; returns the query."""
    use_rocksdb(spark)
    reader = spark.readStream.schema(spark.read.parquet(source_dir).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = history_stream(reader.parquet(source_dir), report_flag, watermark)
    writer = found.writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint_location)
    return writer.trigger(availableNow=True).start()
