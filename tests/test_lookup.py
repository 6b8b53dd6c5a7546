"""Lookup tables (SNK-3) and measured writes (AGG-2)."""

import contextlib
import io
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from eventsieve.operators.cleaning import clean_transform, deduplicate_first
from eventsieve.plans.etl import run_etl
from eventsieve.sinks.lookup import BUCKETS, LookupTable, any_of, buckets_for, save_lookup_table
from eventsieve.sinks.writers import write_measured
from eventsieve.sources.driver_tables import raw_events
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="eventsieve-lookup-"), "t")
    # One user holds a third of all rows.
    rows = spark.range(60_000).select(
        F.concat(F.lit("evt-"), "id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 501).cast("string"))).alias("target_user_id"),
        (F.col("id") % 7).alias("kind"),
    )
    made = save_lookup_table(rows, "lookup_test", path, 60_000)
    yield made
    made.drop(spark)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_users_read_their_buckets_alone(spark, table):
    # Buckets are pruned either way; the plan says so where it does not also split them by size.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        found = table.of_users(spark, ["u1", "u2"])
        assert f"SelectedBucketsCount: {len({hash_bucket(spark, u) for u in ('u1', 'u2')})} out of {BUCKETS}" in plan(found)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert found.count() == spark.range(60_000).filter("id % 3 <> 0 and id % 501 in (1, 2)").count()


def hash_bucket(spark, user):
    return spark.sql(f"SELECT pmod(hash('{user}'), {BUCKETS})").first()[0]


def test_a_join_on_the_user_moves_no_row_of_the_table(spark, table):
    keys = spark.range(20_000).select(F.concat(F.lit("u"), "id").alias("target_user_id"))  # too many to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = table.matching(keys, "target_user_id")
        text = plan(joined)
        assert joined.count() == spark.range(60_000).filter("id % 3 <> 0").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text[: text.index("(1) ")]
    left = tree[tree.index("SortMergeJoin") :].split("\n")[1:]
    ours = left[: next(i for i, line in enumerate(left) if "Scan parquet" in line) + 1]  # the first branch below the join
    assert not any("Exchange" in line for line in ours), tree
    assert f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text


def test_few_keys_are_broadcast_whatever_the_bucket(spark, table):
    keys = spark.createDataFrame([("hot",), ("hot",), ("nobody",)], "target_user_id string")
    found = table.matching(keys, "target_user_id")
    assert "BroadcastHashJoin" in plan(found) and found.count() == 20_000


def test_ids_are_pushed_value_by_value_to_bloom_filters(spark, table):
    ids = [f"evt-{i * 977}" for i in range(25)]
    found = table.of_ids(spark, ids)
    text = plan(found)
    assert "In(event_id" in text or "EqualTo(event_id" in text
    assert sorted(r.event_id for r in found.collect()) == sorted(ids)
    files = [os.path.join(table.path, f) for f in os.listdir(table.path) if f.endswith(".parquet")]
    meta = duckdb.sql(f"SELECT count(*), count(bloom_filter_offset) FROM parquet_metadata({files}) WHERE path_in_schema = 'event_id'").fetchall()[0]
    assert meta[0] > 0 and meta[0] == meta[1]
    assert duckdb.sql(f"SELECT count(bloom_filter_offset) FROM parquet_metadata({files}) WHERE path_in_schema = 'kind'").fetchall()[0][0] == 0


def test_lists_of_keys_are_cut(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert df.filter(any_of("k", [str(i) for i in range(35)])).count() == 35
    assert df.filter(any_of("k", [])).count() == 0


def test_buckets_grow_with_rows_and_divide_each_other():
    sizes = [buckets_for(n) for n in (0, 1, 10**6, 10**8, 10**10, 10**12)]
    assert sizes[0] == BUCKETS and sizes == sorted(sizes) and sizes[-1] > 10**5
    assert all(b % a == 0 for a, b in zip(sizes, sizes[1:]))


def test_etl_counts_come_from_its_writes(spark, tmp_path):
    res = run_etl(spark, raw_events(spark, SF_SMALL), str(tmp_path / "etl"), table_prefix="measured_")
    assert res.counts["input_rows"] == 1000 and res.counts["events_processed"] == res.processed.count() == 960
    assert res.counts["valid_events"] == res.valid.count() and res.counts["rejected_events"] == res.rejected.count()
    assert res.counts["notifications_generated"] == res.notifications.count()
    assert set(res.tables) == {"notifications", "validated_events", "rejected_events"}
    for name, lookup in res.tables.items():
        assert isinstance(lookup, LookupTable) and spark.table("measured_" + name).count() == lookup.read(spark).count() > 0
        lookup.drop(spark)
        assert not spark.catalog.tableExists("measured_" + name)


def test_copies_count_every_input_row(spark):
    rows = [(i, "" if i % 3 == 0 else f"e{i % 50}") for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, event_id string")
    kept = deduplicate_first(df, copies="n").collect()
    assert sum(r.n for r in kept) == 300 and {r.event_id: r.n for r in kept}[""] == 100
    assert "n" not in deduplicate_first(df).columns and "c" in clean_transform(raw_events(spark, SF_SMALL), copies="c").columns


@pytest.mark.parametrize("rows", [0, 5])
def test_measured_write_of_any_size(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    seen = write_measured(spark.range(rows).withColumn("x", F.col("id") * 2), path, {"n": F.count(F.lit(1)), "s": F.coalesce(F.sum("x"), F.lit(0))}, keep=["id"])
    assert seen == {"n": rows, "s": rows * (rows - 1)}
    assert spark.read.schema("id long").parquet(path).count() == rows and spark.read.schema("id long").parquet(path).columns == ["id"]
