"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies.  The
expected copies are prefix-summed along the source (by size, then doc_id, so
that every stretch of sizes is drawn evenly), one offset in [0, 1) per
source is added, and a document is emitted once for each whole number its
stretch of the sum crosses.

The prefix sum is a rank times a constant, so it needs counts only: rows are
range-partitioned and sorted, positions inside a partition are read off, and
the counts of the partitions before are added.  A source that holds most
rows is spread over many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.session import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``(source, size)`` -> ``(source, source_size, target)``, one row per source.

    Sources in code point order, null last, weigh ``weights`` repeating.  A
    target is ``weight * level`` cut at ``most`` times the source's size; the
    level shares all words.  Sources are cut in the order of ``most * size /
    weight``, so one running sum over the sources finds the level: the first
    source in that order which its share would not fill.  The windows hold
    one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * most)
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    level = (
        weighed.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("at", F.row_number().over(by_fill))
        .withColumn("fits", F.col("weight") * F.col("rest") <= F.col("most") * F.col("open"))
        .withColumn("first", F.min(F.when(F.col("fits"), F.col("at"))).over(every))
        .withColumn("level_rest", F.max(F.when(F.col("at") == F.col("first"), F.col("rest"))).over(every))
        .withColumn("level_open", F.max(F.when(F.col("at") == F.col("first"), F.col("open"))).over(every))
    )
    share = (F.col("weight") * F.col("level_rest")).cast("double") / F.col("level_open").cast("double")
    target = F.when(F.col("at") < F.col("first"), F.col("most").cast("double")).otherwise(share)
    return level.select("source", "source_size", "n", F.coalesce(target, F.lit(0.0)).alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """A fixed number in [0, 1) per source, from a digest of its name."""
    digits = F.substring(F.md5(F.concat(F.coalesce(source, F.lit("\u0000")), F.lit(f"|{seed}"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED, carry: bool = False
) -> DataFrame:
    """``docs(doc_id, text, source)`` -> ``(doc_id, source, size, source_size, target, copies, taken)``.

    One row per input row; ``copies`` is how often the mix holds it (0 to
    ``most``) and ``taken`` its words there.  A null or empty text has size 0
    and is never above 0 words; a null source is a source of its own, last; a
    source without words has target 0 and no copies; equal sizes go by
    doc_id, repeated ids in any order of equal rows; a very long text counts
    with all its words; an empty table gives an empty one; other columns are ignored.  Reruns agree.  With ``carry`` the
    whole input row comes along as the struct ``row``.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"), *row,
    )
    if not carry:
        sized = materialize(sized)  # range splitters are sampled first; texts are read once
    by = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    ordered = materialize(
        sized.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33).cast("int"))
    )
    # One row per source and range partition: the position where the source starts there, and the ranks before it.
    pieces = ordered.groupBy("part", "source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    totals = source_targets(ordered, weights, most)
    plan = pieces.join(totals, pieces.source.eqNullSafe(totals.source)).select(
        F.col("part").alias("p_part"), pieces.source.alias("p_source"), "first", "before", "source_size", "target"
    )
    joined = ordered.join(plan, (F.col("part") == F.col("p_part")) & F.col("source").eqNullSafe(F.col("p_source")))
    rank = F.col("at") - F.col("first") + F.col("before")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _offset(F.col("source"), seed)
    crossed = F.floor((rank + 1) * expected + offset) - F.floor(rank * expected + offset)
    copies = F.least(crossed, F.lit(most)).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )


ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS most,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM sized GROUP BY source),
level(step, bound) AS (
  SELECT 0, CAST(-1 AS DOUBLE)
  UNION ALL
  SELECT l.step + 1, coalesce((SELECT (sum(source_size) - coalesce(sum(most) FILTER (WHERE most / weight <= l.bound), 0))
                                      / nullif(sum(weight) FILTER (WHERE most / weight > l.bound), 0) FROM totals), l.bound)
  FROM level l WHERE l.step <= (SELECT count(*) FROM totals)),
last AS (SELECT bound FROM level ORDER BY step DESC LIMIT 1),
rest AS (
  SELECT sum(source_size) - coalesce(sum(most) FILTER (WHERE most / weight < bound), 0) AS words,
         sum(weight) FILTER (WHERE most / weight >= bound) AS open, any_value(bound) AS bound
  FROM totals, last),
aims AS (
  SELECT source, source_size,
         CASE WHEN most / weight < bound THEN CAST(most AS DOUBLE)
              ELSE CAST(weight * words AS DOUBLE) / CAST(open AS DOUBLE) END AS target,
         CAST('0x' || substr(md5(coalesce(source, chr(0)) || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM totals, rest),
placed AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, a.shift,
         CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS expected,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS r
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor((r + 1) * expected + shift) - floor(r * expected + shift), 3) * size AS BIGINT) AS taken
FROM placed
"""


def q_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
