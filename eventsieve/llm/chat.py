"""Chat formatting as a prefix tree: shared first turns are emitted once.

Conversations that begin with the same turns share them.  A turn's key chains
the digests of all turns up to it, so equal keys are equal prefixes.  Each
tree node (a distinct prefix) belongs to the smallest conversation that has
it; the nodes a conversation owns are the end of its path, and form one
segment of the output.  A segment holds its turns' text and tokens once, the
position of its first token within the conversation, its place in the depth-
first layout, and the stretches of the layout its tokens may attend to: for
every ancestor segment the first tokens up to the branch.

The layout order is a sort by ``(owner, -branch depth, ...)`` along the path:
a segment precedes its branches, deeper branches come first.  Offsets are a
prefix sum over range partitions, so no tree needs a task of its own, however
many conversations share its root.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventsieve.llm.tokens import encoder, public_vocabulary, read_ranks
from eventsieve.session import materialize, only_result

# The template: what opens and closes a turn of each role.  Texts escape its first characters.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER = ("[ROLE {role}] ", " [/ROLE]")
LEARNED = "assistant"
ESCAPED = r"([\\<\[\]])"
NO_CONVERSATION = -(1 << 63)  # stands for a null conv_id

OPENS = re.compile(r"(\[INST\] |<s> |<<SYS>> |\[ROLE (?:[^\\<\[\]]|\\.)*+\] )((?:[^\\<\[\]]|\\.)*+)", re.S)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def formatted(role: Column, text: Column) -> tuple[Column, Column]:
    """The opening of a turn, and the whole of it."""
    opening = F.concat(F.lit(OTHER[0].split("{")[0]), escaped(role), F.lit(OTHER[0].split("}")[1]))
    closing = F.lit(OTHER[1])
    for name, (a, b) in MARKS.items():
        opening, closing = F.when(role == name, F.lit(a)).otherwise(opening), F.when(role == name, F.lit(b)).otherwise(closing)
    return opening, F.concat(opening, escaped(text), closing)


def parse(text: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted conversation."""
    out, at = [], 0
    roles = {a: (r, b) for r, (a, b) in MARKS.items()}
    while at < len(text):
        m = OPENS.match(text, at)
        role, closing = roles.get(m[1]) or (unescaped(m[1][6:-2]), OTHER[1])
        body = m[2][:-1]  # the closing mark begins with a space
        if not text.startswith(closing, m.end() - 1):
            raise ValueError("a turn is not closed")
        out.append((role, unescaped(body)))
        at = m.end() - 1 + len(closing)
    return out


def _paths(turns: DataFrame) -> DataFrame:
    """``(conv, i, key, role, text)``: every turn with the key of the prefix that ends in it."""
    row = F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_CONVERSATION)).alias("conv")
    whole = turns.select(conv, row.alias("t")).groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    link = lambda before, t: F.md5(F.concat(before, F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]))
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(""))
    keys = F.aggregate("t", F.array().cast("array<string>"), lambda acc, t: F.concat(acc, F.array(link(last(acc), t))))
    zipped = F.posexplode(F.arrays_zip(keys.alias("key"), F.col("t").alias("t")))
    return whole.select("conv", zipped.alias("i", "z")).select("conv", "i", "z.key", "z.t.role", "z.t.text")


def _nodes(paths: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``(key, owner, i, text, loss_from, loss_to, n_tokens, tokens)``: every distinct prefix's last turn, once."""
    once = paths.groupBy("key").agg(F.min("conv").alias("owner"), F.first("i").alias("i"), F.first("role").alias("role"), F.first("text").alias("text"))
    opening, text = formatted(F.col("role"), F.col("text"))
    learned = F.col("role") == LEARNED
    spans = once.select(
        "key", "owner", "i", text.alias("text"), F.when(learned, F.length(opening)).otherwise(0).cast("int").alias("loss_from"),
        F.when(learned, F.length(opening) + F.length(escaped(F.col("text")))).otherwise(0).cast("int").alias("loss_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).encode_ordinary
        for batch in batches:
            tokens = [encode(t) for t in batch.column(3).to_pylist()]
            packed = pa.array([np.array(t, "<u2").tobytes() for t in tokens], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(t) for t in tokens], pa.int64()), packed], names=[*batch.schema.names, "n_tokens", "tokens"])

    return spans.mapInArrow(run, "key string, owner long, i int, text string, loss_from int, loss_to int, n_tokens long, tokens binary")


def format_conversations(turns: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(segments, paths)`` of ``turns(conv_id, turn, role, text)``.

    ``segments``: ``(owner, at, first_position, n_tokens, turns, attends)``,
    one row per conversation that adds something.  ``at`` is its place in the
    depth-first layout; token ``j`` has position ``first_position + j`` and
    attends to ``attends`` (stretches ``[from, to)`` of the layout, whole)
    and to its own segment up to itself.  ``turns`` holds each turn's
    formatted text, its characters under the loss mask, and its tokens.
    ``paths``: ``(conv, place, owner, n_turns, n_tokens)``, the segments
    whose first turns make up each conversation, in order.

    Turns go by ``turn``, then role and text; null roles and texts are empty;
    rows with a null conv_id are one conversation; equal conversations share
    everything; an empty table gives empty ones; other columns are ignored.
    """
    spark = turns.sparkSession
    path = materialize(_paths(turns))
    nodes = materialize(_nodes(path, read_ranks(vocabulary or public_vocabulary())))
    steps = path.select("conv", "i", "key").join(nodes.select("key", "owner", "n_tokens"), "key")
    runs = steps.groupBy("conv", "owner").agg(F.min("i").alias("from"), F.count(F.lit(1)).alias("n_turns"), F.sum("n_tokens").alias("n_tokens"))
    ordered = F.sort_array(F.collect_list(F.struct("from", "owner", "n_turns", "n_tokens")))
    lines = runs.groupBy("conv").agg(ordered.alias("runs"))
    # Layout order: owners along the path, each with its branch depth, deeper branches first.
    order = F.flatten(F.transform("runs", lambda r: F.array(r["owner"], -(r["from"] + r["n_turns"]))))
    own = F.element_at("runs", -1)
    segments = lines.filter(own["owner"] == F.col("conv")).select(
        F.col("conv").alias("owner"), F.slice(order, 1, F.size(order) - 1).alias("order"), own["n_tokens"].alias("n_tokens"),
        F.slice("runs", 1, F.size("runs") - 1).alias("above"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(
        segments.repartitionByRange(parts, "order").sortWithinPartitions("order")
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33).cast("int"))
    )
    sums = dealt.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))  # a row per range partition
    sums = sums.withColumn("before", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("place")) - F.col("n_tokens")
    placed = materialize(dealt.withColumn("within", within).join(sums.select("part", "before"), "part").withColumn("at", F.col("before") + F.col("within")))
    starts = placed.select(F.col("owner").alias("o"), F.col("at").alias("o_at"))
    above = placed.select("owner", F.explode("above").alias("a")).select("owner", F.col("a.owner").alias("o"), F.col("a.from").alias("depth"), F.col("a.n_tokens").alias("n"))
    attends = above.join(starts, "o").groupBy("owner").agg(
        F.sum("n").alias("first_position"),
        F.transform(F.sort_array(F.collect_list(F.struct("depth", "o_at", "n"))), lambda x: F.struct(x["o_at"].alias("from"), (x["o_at"] + x["n"]).alias("to"))).alias("attends"),
    )
    content = nodes.groupBy("owner").agg(F.sort_array(F.collect_list(F.struct("i", "text", "loss_from", "loss_to", "n_tokens", "tokens"))).alias("turns"))
    empty = F.array().cast("array<struct<from:bigint,to:bigint>>")
    out = placed.select("owner", "at", "n_tokens").join(attends, "owner", "left").join(content, "owner").select(
        "owner", "at", F.coalesce("first_position", F.lit(0)).alias("first_position"), "n_tokens", "turns", F.coalesce("attends", empty).alias("attends")
    )
    return materialize(out), runs.select("conv", F.col("from").alias("place"), "owner", "n_turns", "n_tokens")


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, shared_turns long, shared_chars long, "
    "first_position long, n_tokens long, attended_tokens long"
)


def read_back(segments: DataFrame, paths: DataFrame) -> DataFrame:
    """Every conversation parsed out of the segments on its path, with digests of what was read.

    ``shared_turns`` and ``shared_chars`` stand in segments of other
    conversations; ``first_position`` is where its own segment's positions begin
    (its tokens in all, where it has none), ``n_tokens`` the tokens of all its turns, and ``attended_tokens`` those
    of the stretches that its own segment attends to.
    """
    attended = F.aggregate("attends", F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"])
    shared = segments.select(
        "owner", F.transform("turns", lambda t: F.struct(t["text"], t["loss_from"], t["loss_to"])).alias("turns"), "first_position", attended.alias("attended"),
    )
    own = F.col("owner") == F.col("conv")
    pieces = paths.join(shared, "owner").select(
        "conv", "place", own.alias("own"), "n_tokens", F.slice("turns", F.lit(1), F.col("n_turns").cast("int")).alias("turns"),
        F.when(own, F.col("first_position")).alias("first_position"), F.when(own, F.col("attended")).alias("attended"),
    )
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]))
    whole = pieces.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "turns"))).alias("p"),
        F.sum(F.when(F.col("own"), 0).otherwise(F.size("turns"))).cast("long").alias("shared_turns"),
        F.sum(F.when(F.col("own"), 0).otherwise(chars)).cast("long").alias("shared_chars"),
        F.coalesce(F.max("first_position"), F.sum("n_tokens")).alias("first_position"), F.sum("n_tokens").alias("n_tokens"),
        F.coalesce(F.max("attended"), F.lit(0)).alias("attended_tokens"),
    )
    counts = ["shared_turns", "shared_chars", "first_position", "n_tokens", "attended_tokens"]
    lines = whole.select("conv", F.flatten(F.transform("p", lambda x: x["turns"])).alias("turns"), *counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turns, *known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = "".join(t["text"] for t in turns)
                read = parse(text)
                learned = "".join(unescaped(t["text"][t["loss_from"] : t["loss_to"]]) for t in turns)
                said = "".join(f"{r}\n{x}\n" for r, x in read)
                rows.append((
                    None if conv == NO_CONVERSATION else conv, len(read), hashlib.sha256(said.encode()).hexdigest(),
                    len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text), *known,
                ))
            kinds = [pa.string() if "string" in c else pa.int64() for c in READ.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in READ.split(", ")])

    return lines.mapInArrow(run, READ)


def q_chat(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(extra)
    with only_result(spark) as keep:
        return keep(read_back(*format_conversations(turns)).drop("first_position", "n_tokens", "attended_tokens"))


# The same rows in SQL.
ORACLE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(regexp_replace(text, '([\\<\[\]])', '\\\1', 'g')) AS body,
         CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('<s>  </s>') WHEN 'system' THEN length('<<SYS>>  <</SYS>>')
                   ELSE length('[ROLE ]  [/ROLE]') + length(regexp_replace(role, '([\\<\[\]])', '\\\1', 'g')) END AS marks
  FROM turns),
prefixes AS (
  SELECT *, string_agg(length(role) || ':' || role || length(text) || ':' || text, chr(0)) OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM sized),
owned AS (SELECT *, min(conv_id) OVER (PARTITION BY prefix) AS owner FROM prefixes)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + marks) AS BIGINT) AS formatted_chars,
       CAST(count_if(owner <> conv_id) AS BIGINT) AS shared_turns,
       CAST(coalesce(sum(body + marks) FILTER (WHERE owner <> conv_id), 0) AS BIGINT) AS shared_chars
FROM owned GROUP BY conv_id
"""
