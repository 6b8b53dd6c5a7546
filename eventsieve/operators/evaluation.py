"""Classifier evaluation on a scored table (AGG-9, WIN-2/3, ML-7, ML-8, FLT-7, NUM-5).

Input: any DataFrame with a 0/1 label and a probability column.  Everything
is computed from the per-score table ``(score, positives, negatives)``,
which is a partial-aggregated ``groupBy(score)``:

* ROC points: cumulative positives/negatives in descending score order;
  the cumulative sums use the range-partitioned prefix sum, so many
  distinct scores never meet in one task (the reference loops over every
  threshold and every row);
* AUC: trapezoids between consecutive points, summed in one aggregate;
* the confusion counts at the threshold are sums over scores >= threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.functions.numeric import ratio
from eventsieve.operators.indexing import _num_partitions
from eventsieve.session import materialize


def with_prefix_sums(
    df: DataFrame,
    order_by: list[Column],
    sums: dict[str, str],
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums in ``order_by`` order without a single task.

    Range-partition on the key, running sum inside each partition, then add
    the prefix of the partition totals (one row per partition, broadcast)."""
    parts = _num_partitions(df, num_partitions)
    ranged = materialize(df.repartitionByRange(parts, *order_by).withColumn("_pid", F.spark_partition_id()))
    local_w = Window.partitionBy("_pid").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(src).over(local_w).alias(f"_loc_{out}") for out, src in sums.items()])
    totals = ranged.groupBy("_pid").agg(*[F.sum(src).alias(f"_tot_{out}") for out, src in sums.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_tot_{out}").over(before), F.lit(0)).alias(f"_off_{out}") for out in sums]
    )
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{out}") + F.col(f"_loc_{out}")).alias(out) for out in sums],
    )


def score_table(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives and negatives (map-side combined)."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )


def _cumulative(scored: DataFrame, label: str, score: str) -> DataFrame:
    table = score_table(scored, label, score)
    return with_prefix_sums(table, [F.col("score").desc()], {"cum_pos": "pos", "cum_neg": "neg"})


def roc_curve(scored: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """ML-8: ``(point, false_positive_rate, true_positive_rate)`` for
    thresholds +inf, every distinct score (descending) and -inf; rates use
    ``max(1, class size)``.  ``point`` counts them from 0."""
    cum = with_prefix_sums(
        score_table(scored, label, score).withColumn("one", F.lit(1)),
        [F.col("score").desc()], {"cum_pos": "pos", "cum_neg": "neg", "point": "one"},
    )
    # Class sizes: one bounded row, read once on the driver as literals.
    totals = cum.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("P"), F.coalesce(F.sum("neg"), F.lit(0)).alias("N"), F.count(F.lit(1)).alias("points")
    ).first()
    P, N = F.lit(int(totals["P"])), F.lit(int(totals["N"]))
    per_score = cum.select(
        F.col("point").cast("bigint").alias("point"),
        ratio(F.col("cum_neg"), N).alias("false_positive_rate"),
        ratio(F.col("cum_pos"), P).alias("true_positive_rate"),
    )
    ends = scored.sparkSession.createDataFrame(
        [(0, 0.0, 0.0), (int(totals["points"]) + 1, int(totals["N"]) / max(1, int(totals["N"])), int(totals["P"]) / max(1, int(totals["P"])))],
        "point bigint, false_positive_rate double, true_positive_rate double",
    )
    return per_score.unionByName(ends)


def classification_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """ML-7: one row with accuracy, precision, recall, F1 (from unrounded
    precision and recall), ROC AUC, Gini and the four confusion counts."""
    cum = _cumulative(scored, label, score)
    P = F.sum("pos")
    N = F.sum("neg")
    # Trapezoid of the segment ending at this score (WIN-3 without lag).
    seg = F.col("neg") * (F.lit(2) * F.col("cum_pos") - F.col("pos"))
    agg = cum.agg(
        P.alias("P"),
        N.alias("N"),
        F.sum(F.when(F.col("score") >= threshold, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("score") >= threshold, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(seg.cast("double")).alias("_area2"),
    )
    tp, fp = F.coalesce(F.col("tp"), F.lit(0)), F.coalesce(F.col("fp"), F.lit(0))
    fn, tn = F.col("P") - tp, F.col("N") - fp
    precision = ratio(tp, tp + fp)
    recall = ratio(tp, tp + fn)
    f1 = F.lit(2.0) * precision * recall / F.greatest(F.lit(1e-12), precision + recall)
    auc = F.coalesce(F.col("_area2"), F.lit(0.0)) / (
        F.lit(2.0) * F.greatest(F.lit(1.0), F.col("N").cast("double")) * F.greatest(F.lit(1.0), F.col("P").cast("double"))
    )
    # The -inf end point adds (1,1)->(N/max(1,N), P/max(1,P)); zero width unless a class is empty.
    total = F.greatest(F.lit(1), tp + fp + fn + tn)
    return agg.select(
        F.round(ratio(tn + tp, total), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
        F.round(f1, 4).alias("f1_score"),
        F.round(auc, 4).alias("roc_auc"),
        F.round(F.lit(2.0) * auc - F.lit(1.0), 4).alias("gini"),
        F.lit(float(threshold)).alias("threshold"),
        tn.cast("bigint").alias("true_negatives_valid_detected"),
        fp.cast("bigint").alias("false_positives_valid_marked_risky"),
        fn.cast("bigint").alias("false_negatives_risky_marked_valid"),
        tp.cast("bigint").alias("true_positives_risky_detected"),
    )


def confusion_matrix(scored: DataFrame, label: str = "label", score: str = "probability", threshold: float = 0.5) -> DataFrame:
    """AGG-9: rows ``real_valido`` / ``real_riesgoso``, columns
    ``pred_valido`` / ``pred_riesgoso`` (a two-value pivot with fixed values)."""
    predicted = (F.col(score) >= threshold).cast("int")
    real = F.when(F.col(label) == 1, "real_riesgoso").otherwise("real_valido")
    return (
        scored.groupBy(real.alias("real_class"))
        .agg(
            F.count_if(predicted == 0).alias("pred_valido"),
            F.count_if(predicted == 1).alias("pred_riesgoso"),
        )
    )
