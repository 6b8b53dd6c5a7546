"""Segmented scans against plain windows, with groups that span partitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventsieve.operators.indexing import with_rank_within
from eventsieve.operators.scan import Scan, segmented_scan


def make(spark, rows):
    return spark.createDataFrame(rows, "g string, t int, id int, v long, w long")


def plain(df):
    run = Window.partitionBy("g").orderBy(F.col("t").asc_nulls_first(), "id").rowsBetween(Window.unboundedPreceding, 0)
    inner = Window.partitionBy("g", "t").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*", F.sum("v").over(run).alias("run"), F.min("w").over(Window.partitionBy("g")).alias("low"),
        F.sum("v").over(Window.partitionBy("g")).alias("total"), F.sum("v").over(inner).alias("k"), F.sum("v").over(Window.partitionBy("g", "t")).alias("n"),
    )


def ours(df, parts):
    return segmented_scan(
        df, ("g", "t"), [F.col("id")],
        [Scan(("g",), running={"run": "v"}, totals={"total": "v"}, lows={"low": "w"}), Scan(("g", "t"), running={"k": "v"}, totals={"n": "v"})], parts,
    )


def as_set(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("shape", ["mixed", "one group", "one time", "small groups", "nulls"])
def test_scans_equal_windows(spark, parts, shape):
    rng = random.Random(hash(shape) % 100 + parts)
    pick = {
        "mixed": lambda: (rng.choice(["hot"] * 5 + list("abc") + [None]), rng.choice([None, 1, 1, 1, 2, 3])),
        "one group": lambda: ("x", rng.randint(0, 50)), "one time": lambda: ("x", 7),
        "small groups": lambda: (f"g{rng.randint(0, 400)}", rng.randint(0, 3)), "nulls": lambda: (None, None),
    }[shape]
    df = make(spark, [(*pick(), i, rng.randint(-3, 9), rng.choice([None, rng.randint(0, 99)])) for i in range(600)])
    columns = ["g", "t", "id", "run", "low", "total", "k", "n"]
    assert as_set(ours(df, parts), columns) == as_set(plain(df), columns)


def test_empty_frame_and_wrong_groups(spark):
    assert ours(make(spark, []), 4).collect() == []
    with pytest.raises(ValueError):
        segmented_scan(make(spark, []), ("g", "t"), [F.col("id")], [Scan(("t",), running={"r": "v"})])


def test_no_task_holds_a_hot_group_and_carries_stay_small(spark):
    df = make(spark, [("hot", i % 7, i, 1, 1) for i in range(20_000)] + [(f"g{i}", 1, i, 1, 1) for i in range(20_000, 22_000)])
    out = segmented_scan(df, ("g",), [F.col("t"), F.col("id")], [Scan(("g",), running={"r": "v"})], 16)
    assert out.filter("g = 'hot'").agg(F.max("r")).first()[0] == 20_000
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_ranks_of_a_hot_group_without_a_join_on_it(spark):
    df = make(spark, [(("hot" if i % 3 else None), i % 11, i, 1, 1) for i in range(5_000)])
    order = [F.col("t").desc_nulls_last(), F.col("id").asc()]
    ranked = with_rank_within(df, "g", order, "r", num_partitions=7)
    expected = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)) - 1)
    assert ranked.columns == [*df.columns, "r"]
    assert as_set(ranked, ["id", "r"]) == as_set(expected, ["id", "r"])
