"""Split, standardisation and linear scoring (ML-1, ML-2, ML-3, ML-5, ML-15, AGG-11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.config import (
    DEFAULT_RULES,
    FEATURE_COLUMNS,
    LABEL_COLUMN,
    LABEL_RISKY,
    LABEL_VALID,
    REFERENCE_MEAN,
    REFERENCE_STD,
    REFERENCE_WEIGHTS,
    RuleConfig,
)
from eventsieve.functions.numeric import linear_score
from eventsieve.operators.indexing import broadcast_if_small
from eventsieve.operators.scan import Scan, segmented_scan
from eventsieve.session import materialize


@dataclass(frozen=True)
class LinearModel:
    """Intercept + one weight per feature, applied to standardised features."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def probability(self):
        return linear_score(self.features, self.weights, self.mean, self.std, self.intercept)


REFERENCE_MODEL = LinearModel(
    FEATURE_COLUMNS, REFERENCE_WEIGHTS[0], REFERENCE_WEIGHTS[1:], REFERENCE_MEAN, REFERENCE_STD
)


def split_key(id_col: str, seed: int):
    """Deterministic per-row shuffle key, equal in Spark and SQL engines."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit("|"), F.lit(str(seed))))


def stratified_split(
    features: DataFrame,
    id_col: str = "seq",
    label: str = LABEL_COLUMN,
    rules: RuleConfig = DEFAULT_RULES,
) -> DataFrame:
    """ML-1: add ``split`` = ``test`` / ``train``.  Per class, the first
    ``max(1, round_half_even(n * test_fraction))`` rows in ``md5(id|seed)``
    order are test.  A null label is a class, a null id comes first.

    Rows are not sorted: a row is test if its key comes before the class's last
    test key, which ``_cutoffs`` finds from counts of keys.  ``features`` is read
    for its ids and labels by that and once by the result: give it stored.  Only
    rows that share the last test key are ranked, where not all of them are test.
    """
    keyed = features.withColumn("_key", F.coalesce(split_key(id_col, rules.seed), F.lit("")))
    cuts = materialize(_cutoffs(keyed.select(F.col(label).alias("_class"), "_key"), rules))
    cut_rows = broadcast_if_small(cuts)
    placed = keyed.join(cut_rows, F.col(label).eqNullSafe(F.col("_class")), "left")
    tied = (F.col("_key") == F.col("_last")) & (F.col("_taken") < F.col("_ties"))
    done = ["_key", *cuts.columns]
    split = F.when(F.col("_key") <= F.col("_last"), "test").otherwise("train")
    if cuts.filter(F.col("_taken") < F.col("_ties")).isEmpty():
        return placed.withColumn("split", split).drop(*done)
    ranked = segmented_scan(
        placed.filter(tied).withColumn("_one", F.lit(1).cast("long")), (label,), [F.col(id_col)], [Scan((label,), running={"_rank": "_one"})]
    ).withColumn("split", F.when(F.col("_rank") <= F.col("_taken"), "test").otherwise("train"))
    return placed.filter(~tied).withColumn("split", split).drop(*done).unionByName(ranked.drop("_one", "_rank", *done))


KEY_PREFIX = 4  # hex digits: at most 65,537 prefixes a class


def _cutoffs(keyed: DataFrame, rules: RuleConfig) -> DataFrame:
    """``(_class, _key)`` -> ``(_class, _last, _ties, _taken)``: the key of the class's last test row, the
    rows of that key, and how many of them are test.

    Counts of key prefixes find the prefix in which the test rows end, counts
    of that prefix's keys the key; the windows run over such counts only."""
    prefixes = keyed.groupBy("_class", F.substring("_key", 1, KEY_PREFIX).alias("_prefix")).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    sized = prefixes.withColumns({"_cum": F.sum("_c").over(running), "_size": F.sum("_c").over(Window.partitionBy("_class"))})
    wanted = F.greatest(F.lit(1), F.bround(F.col("_size") * F.lit(rules.test_fraction), 0).cast("bigint"))
    ends = sized.withColumn("_left", wanted - F.col("_cum") + F.col("_c")).filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_c")))
    ends = broadcast_if_small(materialize(ends.select(F.col("_class").alias("_of"), "_prefix", "_left")))
    within = keyed.join(ends, F.col("_class").eqNullSafe(F.col("_of")) & (F.substring("_key", 1, KEY_PREFIX) == F.col("_prefix")))
    keys = within.groupBy("_class", "_key").agg(F.count(F.lit(1)).alias("_ties"), F.first("_left").alias("_left"))
    before = F.sum("_ties").over(Window.partitionBy("_class").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_ties")
    taken = keys.withColumn("_taken", F.col("_left") - before).filter(F.col("_taken") > 0)
    last = taken.filter(F.col("_taken") <= F.col("_ties"))
    return last.select("_class", F.col("_key").alias("_last"), "_ties", "_taken")


def train_statistics(train: DataFrame, columns=FEATURE_COLUMNS) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """AGG-11: mean and population std per column (zero std -> 1.0), one pass."""
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    mean = tuple(float(row[f"m{i}"] or 0.0) for i in range(len(columns)))
    std = tuple(float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(len(columns)))
    return mean, std


def standardize(df: DataFrame, mean, std, columns=FEATURE_COLUMNS, suffix: str = "_z") -> DataFrame:
    """ML-2: ``(x - mean) / std`` with the train statistics."""
    return df.withColumns(
        {f"{c}{suffix}": (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, mean, std)}
    )


def baseline_probability(train: DataFrame, label: str = LABEL_COLUMN) -> float:
    """ML-3: the train positive rate, used as a constant probability."""
    value = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return float(value) if value is not None else 0.0


def score_linear(
    features: DataFrame,
    model: LinearModel = REFERENCE_MODEL,
    threshold: float = 0.5,
    out: str = "risk_probability",
) -> DataFrame:
    """ML-5 / ML-15: probability (rounded to 4) and ``riesgoso``/``valido``
    from the unrounded probability (``p >= threshold``)."""
    p = model.probability()
    return features.withColumn("_p", p).select(
        "*",
        F.round("_p", 4).alias(out),
        F.when(F.col("_p") >= threshold, LABEL_RISKY).otherwise(LABEL_VALID).alias("prediction"),
    ).drop("_p")
