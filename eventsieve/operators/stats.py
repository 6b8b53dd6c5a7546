"""Quality statistics, value counts and correlation (AGG-3..8, AGG-12/13, FLT-5, SET-3).

Means, modes and exact quantiles (pandas' linear interpolation) all come
from one table of rows per distinct value with its running total, which is
range-partitioned in ``(name, value)`` order.  Unlike ``percentile`` and
``median`` aggregates, nothing holds a map of all distinct values in one
task, so continuous columns at any size are fine.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve.config import (
    FEATURE_COLUMNS,
    GROUP_BLANK_VALUE,
    IMPUTATION_NOTE,
    LABEL_COLUMN,
    STATISTIC_COLUMNS,
    STATISTIC_SUFFIX_PATTERN,
)
from eventsieve.operators.evaluation import with_prefix_sums
from eventsieve.operators.indexing import broadcast_if_small
from eventsieve.session import materialize


def value_distribution(long: DataFrame) -> DataFrame:
    """``long(name, value)`` -> stored ``(name, value, c, cum)``: rows per
    distinct value and their running total over all names; nulls left out.

    One partial-aggregated pass over the rows; means, modes and quantiles all
    read this table.  The running total is range-partitioned, so columns of
    many distinct values never meet in one task."""
    counts = long.filter(F.col("value").isNotNull()).groupBy("name", "value").agg(F.count(F.lit(1)).alias("c"))
    return materialize(with_prefix_sums(counts, [F.col("name"), F.col("value")], {"cum": "c"}))


def _bounds(dist: DataFrame) -> DataFrame:
    """One row per column: first running total, rows, mean, count of the mode."""
    return dist.groupBy("name").agg(
        F.min(F.col("cum") - F.col("c")).alias("_start"), F.sum("c").alias("_n"),
        (F.sum(F.col("value") * F.col("c")) / F.sum("c")).alias("_mean"), F.max("c").alias("_most"),
    )


def _quantiles(dist: DataFrame, probabilities) -> DataFrame:
    """``(name, p, value)`` by linear interpolation between order statistics."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    wanted = _bounds(dist).select("name", "_start", "_n", F.explode(probs).alias("p")).withColumn("_pos", F.col("p") * (F.col("_n") - 1))
    ends = F.array(F.floor("_pos").cast("bigint"), F.ceil("_pos").cast("bigint"))
    # Columns x probabilities x 2 rows.
    ranks = broadcast_if_small(wanted.select(F.col("name").alias("_name"), "p", "_pos", F.posexplode(ends).alias("_side", "_rank"), "_start"))
    at = F.col("_start") + F.col("_rank")
    picked = dist.join(ranks, (F.col("name") == F.col("_name")) & (at >= F.col("cum") - F.col("c")) & (at < F.col("cum")))
    low, high = (F.max(F.when(F.col("_side") == k, F.col("value"))) for k in (0, 1))
    return picked.groupBy("name", "p", "_pos").agg((low + (high - low) * (F.col("_pos") - F.floor("_pos"))).alias("value")).drop("_pos")


def exact_quantiles(long: DataFrame, probabilities=(0.25, 0.5, 0.75)) -> DataFrame:
    """``long(name, value)`` -> ``(name, p, value)``, linear interpolation
    between order statistics; nulls ignored; a column with no value gets null."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    names = long.select("name").distinct().select("name", F.explode(probs).alias("p"))
    return names.join(_quantiles(value_distribution(long), probabilities), ["name", "p"], "left")


def _modes(dist: DataFrame) -> DataFrame:
    most = _bounds(dist).select(F.col("name").alias("_name"), "_most")
    same = (F.col("name") == F.col("_name")) & (F.col("c") == F.col("_most"))
    return dist.join(broadcast_if_small(most), same).groupBy("name").agg(F.min("value").alias("value"))


def modes(long: DataFrame) -> DataFrame:
    """``long(name, value)`` -> ``(name, value)``: most frequent, smallest on ties."""
    return _modes(value_distribution(long))


def to_long(df: DataFrame, columns) -> DataFrame:
    """Unpivot ``columns`` into ``(name, value double)``."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("kv"),
    ).select("kv.name", "kv.value")


def quality_counts(features: DataFrame) -> DataFrame:
    """AGG-3: structural counts in long form (one ``agg`` then ``stack``)."""
    agg = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("has_source_user") == 0).alias("missing_source_user"),
        F.count_if(F.col("has_target_user") == 0).alias("missing_target_user"),
        F.count_if(F.col("has_valid_date") == 0).alias("invalid_dates"),
        F.coalesce(F.sum("is_duplicate"), F.lit(0)).cast("bigint").alias("duplicate_events"),
        F.count_if(F.col("is_allowed_event_type") == 0).alias("invalid_event_types"),
        F.count_if(F.col(LABEL_COLUMN) == 0).alias("valid_events"),
        F.count_if(F.col(LABEL_COLUMN) == 1).alias("risky_events"),
    )
    names = ["rows", "missing_source_user", "missing_target_user", "invalid_dates",
             "duplicate_events", "invalid_event_types", "valid_events", "risky_events"]
    order = {n: i for i, n in enumerate(names)}
    stacked = agg.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(n).cast("double").alias("value"),
                                     F.lit(order[n]).alias("position")) for n in names])).alias("kv")
    )
    return stacked.select("kv.indicator", "kv.value", F.lit(None).cast("string").alias("text_value"), "kv.position")


def quality_statistics(features: DataFrame, columns=STATISTIC_COLUMNS) -> DataFrame:
    """AGG-4: mean, median, mode, p25, p75 per column, rounded to 4 places."""
    dist = value_distribution(to_long(features, columns))
    means = _bounds(dist).select("name", F.col("_mean").alias("value"), F.lit("mean").alias("stat"))
    quants = _quantiles(dist, (0.5, 0.25, 0.75)).select(
        "name",
        F.when(F.col("p") == 0.5, "median").when(F.col("p") == 0.25, "p25").otherwise("p75").alias("stat"),
        "value",
    )
    mode_rows = _modes(dist).withColumn("stat", F.lit("mode"))
    # A column without any value still has its five rows (0.0).
    stats_ = [(c, s) for c in columns for s in ("mean", "median", "mode", "p25", "p75")]
    every = features.sparkSession.createDataFrame(stats_, "name string, stat string")
    stat_order = {"mean": 0, "median": 1, "mode": 2, "p25": 3, "p75": 4}
    col_order = {c: i for i, c in enumerate(columns)}
    allstats = every.join(means.unionByName(quants).unionByName(mode_rows), ["name", "stat"], "left")
    position = F.lit(8) + F.lit(5) * F.element_at(
        F.create_map(*[x for c, i in col_order.items() for x in (F.lit(c), F.lit(i))]), F.col("name")
    ) + F.element_at(F.create_map(*[x for s, i in stat_order.items() for x in (F.lit(s), F.lit(i))]), F.col("stat"))
    return allstats.select(
        F.concat(F.col("name"), F.lit("_"), F.col("stat")).alias("indicator"),
        F.coalesce(F.round("value", 4), F.lit(0.0)).alias("value"),
        F.lit(None).cast("string").alias("text_value"),
        position.alias("position"),
    )


def quality_summary(features: DataFrame) -> DataFrame:
    """AGG-3..5: counts, statistics and the imputation note (``text_value``)."""
    return quality_counts(features).unionByName(quality_statistics(features)).unionByName(imputation_note(features.sparkSession))


def imputation_note(spark) -> DataFrame:
    return spark.createDataFrame(
        [("imputation_strategy", None, IMPUTATION_NOTE, 8 + 5 * len(STATISTIC_COLUMNS))],
        "indicator string, value double, text_value string, position int",
    )


def statistics_part(quality: DataFrame) -> DataFrame:
    """FLT-5 / SET-3: rows whose indicator ends in a statistic suffix."""
    return quality.filter(F.col("indicator").rlike(STATISTIC_SUFFIX_PATTERN))


def operational_part(quality: DataFrame) -> DataFrame:
    return quality.filter(~F.col("indicator").rlike(STATISTIC_SUFFIX_PATTERN))


def value_counts(df: DataFrame, column: str, blank_label: str | None = None, name: str | None = None) -> DataFrame:
    """AGG-6 / AGG-13: counts per value, most frequent first; blanks (or
    nulls) optionally shown as ``blank_label``."""
    key = F.col(column)
    if blank_label is not None:
        key = F.when(F.coalesce(key.cast("string"), F.lit("")) == "", F.lit(blank_label)).otherwise(key.cast("string"))
    out = name or column
    return df.groupBy(key.alias(out)).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.col(out))


def group_count(df: DataFrame, column: str) -> DataFrame:
    """AGG-13: dashboard count by field, blanks as ``sin_valor``."""
    return value_counts(df, column, GROUP_BLANK_VALUE)


def mean_by_group(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """AGG-7: group mean, descending."""
    return df.groupBy(key).agg(F.avg(F.col(value).cast("double")).alias(out)).orderBy(F.desc(out), key)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """AGG-12."""
    return df.select(column).distinct().orderBy(column)


def correlation_matrix(features: DataFrame, columns=FEATURE_COLUMNS + (LABEL_COLUMN,)) -> DataFrame:
    """AGG-8: Pearson matrix with the two-pass (centred) algorithm.

    Pass 1 is one aggregate of per-column mean, variation and nulls, read on
    the driver.  Without nulls each row is packed as one vector, whose centred
    outer products are summed per task and merged in a tree (Spark ML's
    correlation): one matrix comes back instead of a plan of 152 sums.  A
    constant column (``min = max``) gives null cells, as pandas leaves them
    blank.  Where a column holds nulls each pair uses the rows in which both
    have a value, as pandas does; that needs the pair's own sums.  Output
    ``(row_feature, column_feature, correlation)``.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    cols = list(columns)
    complete = features.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    first = complete.agg(
        *[F.avg(f"c{i}").alias(f"m{i}") for i in range(len(cols))],
        *[F.coalesce(F.max(f"c{i}") > F.min(f"c{i}"), F.lit(False)).alias(f"v{i}") for i in range(len(cols))],
        F.count_if(F.greatest(*[F.col(f"c{i}").isNull() for i in range(len(cols))])).alias("nulls"),
    ).first()
    varying = [i for i in range(len(cols)) if first[f"v{i}"]]
    if first["nulls"]:
        return _pairwise_correlation(complete, cols, varying, first)
    at = {c: k for k, c in enumerate(varying)}
    matrix = None
    if varying:
        packed = complete.select(array_to_vector(F.array(*[f"c{i}" for i in varying])).alias("v"))
        matrix = Correlation.corr(packed, "v").first()[0].toArray()
    cells = [
        (a, b, (1.0 if i == j else float(matrix[at[i], at[j]])) if i in at and j in at else None)
        for i, a in enumerate(cols) for j, b in enumerate(cols)
    ]
    return features.sparkSession.createDataFrame(cells, "row_feature string, column_feature string, correlation double")


def _pairwise_correlation(complete: DataFrame, cols: list[str], varying: list[int], first) -> DataFrame:
    """Correlations over the rows in which both columns of a pair have a value."""
    shifted = complete.select(*[(F.col(f"c{i}") - F.lit(float(first[f"m{i}"]))).alias(f"d{i}") for i in varying])
    pairs = list(combinations(varying, 2))
    sums = []
    for i, j in pairs:
        a, b = F.col(f"d{i}"), F.col(f"d{j}")
        both = a.isNotNull() & b.isNotNull()
        for name, value in (("n", F.lit(1.0)), ("a", a), ("b", b), ("aa", a * a), ("bb", b * b), ("ab", a * b)):
            sums.append(F.coalesce(F.sum(F.when(both, value)), F.lit(0.0)).alias(f"{name}_{i}_{j}"))
    row = shifted.agg(*sums) if sums else complete.sparkSession.range(1)
    values = {}
    for i, j in pairs:
        n, a, b, aa, bb, ab = (F.col(f"{x}_{i}_{j}") for x in ("n", "a", "b", "aa", "bb", "ab"))
        spread = (n * aa - a * a) * (n * bb - b * b)
        values[i, j] = F.when(spread > 0, F.try_divide(n * ab - a * b, F.sqrt(spread)))
    cells = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            if i == j:
                value = F.lit(1.0) if i in varying else F.lit(None).cast("double")
            else:
                value = values.get((min(i, j), max(i, j)), F.lit(None).cast("double"))
            cells.append(F.struct(F.lit(cols[i]).alias("row_feature"), F.lit(cols[j]).alias("column_feature"), value.alias("correlation")))
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
