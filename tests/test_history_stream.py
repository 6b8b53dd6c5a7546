"""The streamed history signals against the batch operator, with late rows and a restart."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("google.protobuf")

from eventsieve.operators.history import signals_by_event  # noqa: E402
from eventsieve.streaming.history_stream import start_history_stream  # noqa: E402
from eventsieve.streaming.validation_stream import late_rows  # noqa: E402

def flag():
    return F.col("event_type") == "error"


SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def event(i, second, user, kind="click"):
    import datetime

    return (i, datetime.datetime(2024, 3, 1) + datetime.timedelta(seconds=second), user, kind)


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def batch_rows(spark, rows):
    found = signals_by_event(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", "event_id", flag())
    return {r.event_id: (r.interaction_velocity_5m, round(r.historical_report_rate, 9)) for r in found.collect()}


def streamed(spark, path):
    return {r.event_id: (r.interaction_velocity_5m, round(r.historical_report_rate, 9)) for r in spark.read.parquet(path).collect()}


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path, few_partitions):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    # Out of order within the delay, peers of one time, a user with most rows, a null user.
    rows = [event(i, (i * 37) % 400 + i * 3, 1 if i % 3 else (None if i % 2 else 2), "error" if i % 5 == 0 else "click") for i in range(120)]
    rows += [event(200 + i, 100, 1, "error") for i in range(4)]
    flush = [event(900, 100_000, 99)]
    first, second = rows[:60], rows[60:]
    for part in (first[:30], first[30:]):
        write(spark, part, source)
    query = start_history_stream(spark, source, out, state, flag(), "20 minutes", files_per_batch=1)
    assert query.awaitTermination(120)
    early = streamed(spark, out)
    write(spark, second, source)
    write(spark, flush, source)
    query = start_history_stream(spark, source, out, state, flag(), "20 minutes", files_per_batch=1)
    assert query.awaitTermination(120)
    got = streamed(spark, out)
    assert early.items() <= got.items() and len(spark.read.parquet(out).collect()) == len(got)
    assert got == batch_rows(spark, rows)


def test_late_rows_are_counted_and_change_nothing(spark, tmp_path, few_partitions):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    kept = [event(i, i * 60, 1) for i in range(30)]
    write(spark, kept, source)
    write(spark, [event(500, 50_000, 3)], source)
    query = start_history_stream(spark, source, out, state, flag(), "5 minutes", files_per_batch=1)
    assert query.awaitTermination(120)
    write(spark, [event(100, 30, 1), event(101, 45, 1)], source)  # long after the watermark
    write(spark, [event(901, 200_000, 4)], source)
    query = start_history_stream(spark, source, out, state, flag(), "5 minutes", files_per_batch=1)
    assert query.awaitTermination(120)
    assert late_rows(query) == 2
    got = streamed(spark, out)
    assert {i: v for i, v in got.items() if i < 100} == batch_rows(spark, kept) and not {100, 101} & got.keys()
