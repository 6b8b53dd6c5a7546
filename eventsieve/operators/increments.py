"""Quality statistics from batches that arrive one after the other (AGG-3, AGG-4, AGG-12 over increments).

A batch leaves a state of one row a column: exact counts, sum, least and
greatest value, and two sketches of bounded size (KLL for quantiles, HLL for
distinct values).  States merge in any order and any grouping, so a new batch
never reads the old rows again.  A quantile's rank is within ``RANK_ERROR`` of
the one asked for, a distinct count within about ``DISTINCT_ERROR``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 800
RANK_ERROR = 0.01
HLL_BITS = 14
DISTINCT_ERROR = 0.05

STATE = "column string, n long, nulls long, total double, low double, high double, quantiles binary, distincts binary"


def batch_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``STATE`` of one batch; nulls and NaN are counted as nulls, a batch without rows has a state too."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("cell")
    long = df.select(cells).select("cell.column", F.when(~F.isnan("cell.value"), F.col("cell.value")).alias("value"))
    made = long.groupBy("column").agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"),
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.kll_sketch_agg_double("value", KLL_SIZE).alias("quantiles"), F.hll_sketch_agg(F.col("value").cast("string"), HLL_BITS).alias("distincts"),
    )
    return made


def merge_states(states: DataFrame) -> DataFrame:
    """One state out of many: exact parts add up, sketches merge."""
    return states.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distincts").alias("distincts"),
    )


def state_summary(state: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, n, nulls, mean, low, high, q_25, ..., distinct)``; without values mean and quantiles are null."""
    some = F.col("n") > 0
    return state.select(
        "column", "n", "nulls", F.when(some, F.col("total") / F.col("n")).alias("mean"), "low", "high",
        *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"q_{round(100 * p)}") for p in probabilities],
        F.hll_sketch_estimate("distincts").alias("distinct"),
    )


def rank_errors(df: DataFrame, summary: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, probability, rank_error)``: how far each quantile's rank among the rows of ``df`` is from the one asked for.

    An estimate that equals several rows has all their ranks; its error is the least one."""
    asked = summary.select("column", F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(f"q_{round(100 * p)}").alias("q")) for p in probabilities])).alias("a"))
    asked = asked.select("column", "a.p", "a.q")
    columns = [r["column"] for r in summary.select("column").collect()]  # one row a column
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("cell")
    long = df.select(cells).select("cell.*").filter("value is not null")
    counted = long.join(F.broadcast(asked), "column").groupBy("column", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("up_to")
    )
    wanted = F.col("p") * F.col("n")
    off = F.greatest(F.lit(0.0), F.col("below") - wanted, wanted - F.col("up_to")) / F.col("n")
    return counted.select("column", F.col("p").alias("probability"), off.alias("rank_error"))
