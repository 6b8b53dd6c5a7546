"""Mergeable states of the quality statistics."""

import math

import pytest
from pyspark.sql import functions as F

from eventsieve.operators.increments import DISTINCT_ERROR, RANK_ERROR, batch_state, merge_states, rank_errors, state_summary


@pytest.fixture(scope="module")
def table(spark):
    skewed = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pow(F.col("id") % 997, F.lit(2.0)))
    return spark.range(30_000).select("id", skewed.alias("a"), F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 30_011).cast("double")).alias("b"), F.lit(None).cast("double").alias("c"))


def slices(df, n, own=None):
    states = [batch_state(df.filter(F.col("id") % n == i), ("a", "b", "c")) for i in (own or range(n))]
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out


def test_merged_slices_give_exact_counts_and_bounded_ranks(spark, table):
    summary = state_summary(merge_states(slices(table, 10))).cache()
    rows = {r["column"]: r for r in summary.collect()}
    assert (rows["a"].n, rows["a"].nulls) == (30_000, 0) and (rows["b"].n, rows["b"].nulls) == (27_000, 3_000)
    assert (rows["c"].n, rows["c"].nulls, rows["c"].mean, rows["c"].low, rows["c"].q_50) == (0, 30_000, None, None, None)
    exact = table.agg(F.avg("a"), F.min("a"), F.max("a"), F.avg("b")).first()
    assert (rows["a"].low, rows["a"].high) == (exact[1], exact[2])
    assert math.isclose(rows["a"].mean, exact[0]) and math.isclose(rows["b"].mean, exact[3])
    for r in rank_errors(table, summary).collect():
        assert r.rank_error <= RANK_ERROR, r
    for c in ("a", "b"):
        assert abs(rows[c].distinct / table.select(c).distinct().filter(F.col(c).isNotNull()).count() - 1) <= DISTINCT_ERROR
    summary.unpersist()


def test_order_and_grouping_of_merges_do_not_matter(spark, table):
    at_once = merge_states(slices(table, 4))
    in_steps = merge_states(slices(table, 4, [3]).unionByName(merge_states(slices(table, 4, [2, 0]))).unionByName(slices(table, 4, [1])))
    exact = ("column", "n", "nulls", "low", "high")
    assert sorted(at_once.select(*exact).collect(), key=str) == sorted(in_steps.select(*exact).collect(), key=str)
    assert all(r.rank_error <= RANK_ERROR for r in rank_errors(table, state_summary(in_steps)).collect())


def test_empty_and_nan(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, 2.0), (2, None)], "id long, a double")
    r = state_summary(batch_state(df, ("a",))).first()
    assert (r.n, r.nulls, r.mean, r.q_50, r.distinct) == (1, 2, 2.0, 2.0, 1)
    assert batch_state(df.limit(0), ("a",)).collect() == []
    merged = merge_states(batch_state(df, ("a",)).unionByName(batch_state(df.limit(0), ("a",))))
    assert merged.first().n == 1
