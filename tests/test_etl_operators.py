"""Literal-row cases for cleaning, validation, notifications, KPIs and views."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventsieve.functions.numeric import parse_number
from eventsieve.functions.timestamps import format_millis, parse_timestamp
from eventsieve.operators.cleaning import clean_transform, flag_duplicates
from eventsieve.operators.notifications import calculate_kpis, generate_notifications, recent_views
from eventsieve.operators.rules import QualityGateError, require_columns, require_min_rows, validate_events
from eventsieve.sources.readers import read_raw_csv
from tests.conftest import rows

RAW_SCHEMA = "event_id string, event_type string, source_user_id string, target_user_id string, created_at string, content string"


def test_clean_trims_lowers_and_keeps_first_duplicate(spark):
    raw = spark.createDataFrame(
        [(" evt-001 ", "LIKE", " u01 ", " u02 ", "2026-05-14 10:00:00", ""),
         ("evt-001", "like", "u01", "u02", "2026-05-14 10:00:00", "")],
        RAW_SCHEMA,
    ).coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    out = clean_transform(raw).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.event_id, row.event_type, row.source_user_id) == ("evt-001", "like", "u01")
    assert row.notification_text == "u01 reacciono a tu publicacion"
    assert row.seq == min(r.seq for r in clean_transform(raw).collect())


def test_trim_strips_unicode_whitespace_like_python(spark):
    raw = spark.createDataFrame([("\tevt-9 ", " follow\n", "u1", "u2", "2026-05-14 10:00:00", "")], RAW_SCHEMA).withColumn("seq", F.lit(0))
    row = clean_transform(raw).first()
    assert row.event_id == "evt-9" and row.event_type == "follow"


def test_missing_required_column_is_created_blank(spark):
    raw = spark.createDataFrame([("e1", "like", "u1", "u2", "2026-05-14 10:00:00")],
                                "event_id string, event_type string, source_user_id string, target_user_id string, created_at string")
    assert clean_transform(raw.withColumn("seq", F.lit(0))).first().content == ""


def test_validation_routes_rows_with_ordered_reasons(spark):
    processed = spark.createDataFrame(
        [("evt-001", "comment", "u01", "u02", datetime(2026, 5, 14, 10, 0), "hola"),
         ("evt-002", "share", "u03", "u04", datetime(2026, 5, 14, 10, 1), ""),
         ("evt-003", "follow", "u05", "", datetime(2026, 5, 14, 10, 2), ""),
         ("", "share", "", " ", None, "")],
        "event_id string, event_type string, source_user_id string, target_user_id string, created_at timestamp_ntz, content string",
    )
    valid, rejected = validate_events(processed)
    assert valid.count() == 1
    reasons = dict(rows(rejected, "event_id", "error_reason"))
    assert reasons["evt-002"] == "tipo de evento invalido"
    assert reasons["evt-003"] == "target_user_id vacio"
    assert reasons[""] == ("event_id vacio; tipo de evento invalido; source_user_id vacio; "
                           "target_user_id vacio; fecha invalida")


def test_gates(spark):
    df = spark.createDataFrame([("a",)], "event_id string")
    try:
        require_columns(df, ["event_id", "content", "created_at"])
        raise AssertionError("expected failure")
    except QualityGateError as exc:
        assert "content, created_at" in str(exc)
    try:
        require_min_rows(df, 200)
        raise AssertionError("expected failure")
    except QualityGateError:
        pass


def _valid_frame(spark, data):
    return spark.createDataFrame(
        data,
        "event_id string, event_type string, source_user_id string, target_user_id string, created_at timestamp_ntz, "
        "content string, notification_text string",
    )


def test_notifications_newest_first_with_millis_and_latency(spark):
    valid = _valid_frame(spark, [
        ("evt-old", "like", "u01", "u02", datetime(2026, 5, 14, 9, 0, 1), "", "u01 reacciono a tu publicacion"),
        ("evt-new", "comment", "u03", "u04", datetime(2026, 5, 14, 9, 1, 3), "hola", "u03 comento tu publicacion"),
    ])
    notes = generate_notifications(valid, keep_position=True, num_partitions=2).orderBy("position").collect()
    assert [n.event_id for n in notes] == ["evt-new", "evt-old"]
    assert notes[0].created_at == "2026-05-14 09:01:03.000"
    assert notes[0].delivered_at == "2026-05-14 09:01:05.000"
    assert [n.latency_seconds for n in notes] == [2, 3]
    assert notes[0].notification_id == "ntf-evt-new" and notes[0].delivery_status == "sent"


def test_millis_are_truncated_and_null_is_blank(spark):
    df = spark.createDataFrame([(datetime(2026, 5, 14, 9, 0, 31, 999999),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(format_millis("t")).collect()] == ["2026-05-14 09:00:31.999", ""]


def test_kpis(spark):
    notes = spark.createDataFrame([("sent", 2), ("sent", 4)], "delivery_status string, latency_seconds int")
    rejected = spark.createDataFrame([("evt-003", "fecha invalida")], "event_id string, error_reason string")
    k = calculate_kpis(rejected, notes).first()
    assert (k.events_processed, k.valid_events, k.rejected_events) == (3, 2, 1)
    assert (k.delivery_success_rate_pct, k.error_rate_pct, k.avg_latency_seconds) == (100.0, 33.33, 3.0)
    assert k.completeness_rate_pct == 66.67


def test_kpis_on_empty_inputs_are_zero(spark):
    notes = spark.createDataFrame([], "delivery_status string, latency_seconds int")
    rejected = spark.createDataFrame([], "event_id string, error_reason string")
    k = calculate_kpis(rejected, notes).first()
    assert (k.events_processed, k.delivery_success_rate_pct, k.avg_latency_seconds) == (0, 0.0, 0.0)


def test_recent_views(spark):
    valid = _valid_frame(spark, [
        ("evt-001", "like", "u01", "u02", datetime(2026, 5, 14, 9, 0), "", "x"),
        ("evt-002", "comment", "u03", "u04", datetime(2026, 5, 14, 9, 5), "hola", "x"),
        ("evt-003", "follow", "u05", "u06", datetime(2026, 5, 14, 9, 2), "", "x"),
        ("evt-004", "like", "u07", "u08", datetime(2026, 5, 14, 9, 10), "", "x"),
    ])
    views = recent_views(valid)
    assert [r.event_id for r in views["all"].collect()] == ["evt-004", "evt-002", "evt-003", "evt-001"]
    assert views["all"].first().created_at == "2026-05-14 09:10:00.000"
    assert [r.event_id for r in views["like"].collect()] == ["evt-004", "evt-001"]
    assert [r.event_id for r in views["comment"].collect()] == ["evt-002"]
    assert [r.event_id for r in views["follow"].collect()] == ["evt-003"]


def test_duplicate_flags_follow_input_order(spark):
    raw = spark.createDataFrame([(1, " a"), (2, "a"), (3, "b"), (4, "a ")], "seq long, event_id string")
    flags = dict(rows(flag_duplicates(raw), "seq", "is_duplicate"))
    assert flags == {1: 0, 2: 1, 3: 0, 4: 1}


def test_valid_and_rejected_partition_processed(spark):
    from eventsieve.sources.driver_tables import raw_events
    from tests.conftest import SF_SMALL

    processed = clean_transform(raw_events(spark, SF_SMALL))
    valid, rejected = validate_events(processed)
    assert valid.count() + rejected.count() == processed.count()
    assert processed.groupBy("event_id").count().filter(F.col("count") > 1).count() == 0
    lat = {r[0] for r in generate_notifications(valid).select("latency_seconds").distinct().collect()}
    assert lat <= {2, 3, 4, 5}


def test_timestamp_math_ignores_session_zone(spark):
    from eventsieve.functions.timestamps import add_seconds, epoch_micros, seconds_between

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 59, 59),)], "t timestamp_ntz")
        later = add_seconds("t", F.lit(3))
        row = df.select(seconds_between("t", later).alias("d"), format_millis(later).alias("s"),
                        epoch_micros("t").alias("us")).first()
        assert (row.d, row.s) == (3, "2024-03-10 02:00:02.000")
        assert row.us == int((datetime(2024, 3, 10, 1, 59, 59) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unique_ids_all_survive_whatever_the_partitions(spark, tmp_path):
    wide = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 512) for k in range(4)])
    raw = spark.range(200_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("like").alias("event_type"), F.lit("u").alias("source_user_id"),
        F.lit("v").alias("target_user_id"), F.lit("2026-05-14 10:00:00").alias("created_at"), wide.alias("content"),
    ).repartition(13, "event_id")
    with pytest.raises(ValueError, match="no order"):
        clean_transform(raw)
    raw.write.parquet(str(tmp_path / "raw"))
    scan = spark.read.parquet(str(tmp_path / "raw"))
    assert clean_transform(scan).count() == 200_000
    assert flag_duplicates(scan).agg(F.sum("is_duplicate")).first()[0] == 0


def test_first_file_wins_even_if_it_is_the_smaller(spark, tmp_path):
    head = "event_id,event_type,source_user_id,target_user_id,created_at,content\n"
    (tmp_path / "part-0.csv").write_text(head + "e1,like,first,v,2026-05-14,\n")
    (tmp_path / "part-1.csv").write_text(head + "e1,like,second,v,2026-05-14,\n" + "".join(f"x{i},like,u,v,2026-05-14,{'y' * 50}\n" for i in range(3000)))
    rows_ = clean_transform(read_raw_csv(spark, str(tmp_path / "*.csv"))).filter("event_id = 'e1'").collect()
    assert [r.source_user_id for r in rows_] == ["first"]


def test_numbers_and_dates_take_only_the_listed_forms(spark):
    numbers = {"5d": None, "5f": None, "abc": None, "nan": None, "": None, " 7 ": 7.0, "1e3": 1000.0, ".5": 0.5, "-2.": -2.0, "inf": float("inf"), "0x1p3": None}
    df = spark.createDataFrame([(k,) for k in numbers], "t string")
    assert {r.t: r.n for r in df.select("t", parse_number("t").alias("n")).collect()} == numbers
    dates = {"2026": False, "2026-05": False, "2026-05-14 10:00:00+05:00": False, "2026-05-14T10:00:00Z": False, "2026-05-14": True, "2026-05-14 10:00": True,
             "2026-05-14T10:00:00.123456": True, "2026-02-30": False, "fecha-invalida": False}
    df = spark.createDataFrame([(k,) for k in dates], "t string")
    assert {r.t: r.ok for r in df.select("t", parse_timestamp("t").isNotNull().alias("ok")).collect()} == dates
