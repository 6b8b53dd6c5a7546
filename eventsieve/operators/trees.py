"""Decision trees and forests as column expressions (ML-6, ML-16).

A tree is nested ``when`` over the feature columns, a forest the mean of its
trees' probabilities.  The score is then an ordinary expression: it runs inside
the scan's stage, needs no vector column and no Python, and can be used from SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.config import FEATURE_COLUMNS
from eventsieve.session import delete_path, shared_path


@dataclass(frozen=True)
class Split:
    """Rows with ``feature <= threshold`` go to ``low``, all others (nulls too) to ``high``."""

    feature: str
    threshold: float
    low: Split | float
    high: Split | float


Tree = Split | float  # a leaf is the probability of class 1


def tree_column(tree: Tree) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    below = F.col(tree.feature).cast("double") <= F.lit(float(tree.threshold))
    return F.when(below, tree_column(tree.low)).otherwise(tree_column(tree.high))


def forest_column(trees: list[Tree] | tuple[Tree, ...]) -> Column:
    total = F.lit(0.0)
    for tree in trees:
        total = total + tree_column(tree)
    return total / F.lit(float(len(trees)))


def trees_of(spark: SparkSession, model, columns=FEATURE_COLUMNS) -> list[Tree]:
    """The trees of a fitted random forest or tree classifier of two classes, read from its saved form.

    The number of nodes is bounded by the trees and their depth.
    """
    path = shared_path(spark, "forest")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "treeID" not in rows.columns:
        rows = rows.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    nodes: dict[int, dict[int, object]] = {}
    for r in rows.collect():
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    delete_path(spark, path)

    def built(own: dict, at: int) -> Tree:
        node = own[at]
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            return float(stats[1] / sum(stats)) if sum(stats) else 0.0
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("only splits of numbers are expressions here")
        return Split(columns[split["featureIndex"]], split["leftCategoriesOrThreshold"][0], built(own, node["leftChild"]), built(own, node["rightChild"]))

    return [built(own, 0) for _, own in sorted(nodes.items())]


def score_forest(features: DataFrame, trees, out: str = "probability_risky") -> DataFrame:
    return features.withColumn(out, forest_column(trees))


# A small forest kept as data: fixed values, three levels at most.
STORED_FOREST: tuple[Tree, ...] = (
    Split("historical_report_rate", 0.215, Split("is_duplicate", 0.5, Split("has_valid_date", 0.5, 0.97, 0.12), 0.99), 0.91),
    Split("is_allowed_event_type", 0.5, 0.98, Split("interaction_velocity_5m", 33.5, 0.18, 0.88)),
    Split("has_target_user", 0.5, 0.96, Split("account_age_days", 21.5, Split("historical_report_rate", 0.095, 0.21, 0.83), 0.16)),
    Split("has_source_user", 0.5, 0.95, Split("has_valid_date", 0.5, 0.94, Split("event_type_follow", 0.5, 0.27, 0.19))),
    Split("content_length", 9.5, Split("hour", 5.5, 0.41, 0.33), Split("day_of_week", 4.5, 0.38, 0.44)),
)
