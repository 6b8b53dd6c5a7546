"""The skew-safe plans equal the plain single-window definitions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventsieve.config import RuleConfig
from eventsieve.operators.evaluation import with_prefix_sums
from eventsieve.operators.history import history_signals
from eventsieve.operators.indexing import with_global_index, with_rank_within
from eventsieve.operators.scoring import stratified_split
from eventsieve.operators.stats import exact_quantiles
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_global_index_equals_row_number(events):
    order = [F.col("ts").desc(), F.col("event_id")]
    ours = with_global_index(events, order, "idx", num_partitions=7).select("event_id", "idx")
    plain = events.select("event_id", (F.row_number().over(Window.orderBy(*order)) - 1).alias("idx"))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_rank_within_equals_partitioned_row_number(events):
    order = [F.col("ts"), F.col("event_id")]
    ours = with_rank_within(events, "event_type", order, "r", num_partitions=5).select("event_id", "r")
    plain = events.select("event_id", (F.row_number().over(Window.partitionBy("event_type").orderBy(*order)) - 1).alias("r"))
    assert ours.exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_prefix_sums(events):
    ours = with_prefix_sums(events.select("event_id", "value"), [F.col("event_id")], {"cum": "value"}, num_partitions=6)
    plain = events.select("event_id", F.sum("value").over(Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    got = {r.event_id: r.cum for r in ours.collect()}
    for r in plain.collect():
        assert got[r.event_id] == pytest.approx(r.cum, rel=1e-12)


@pytest.mark.parametrize("window", [300, 900, 3600])
def test_history_signals_equal_per_user_windows(spark, events, window):
    rules = RuleConfig(velocity_window_seconds=window)
    ours = history_signals(events, "user_id", "ts", "event_id", F.col("event_type") == "error", rules)
    events.createOrReplaceTempView("ev_hist")
    plain = spark.sql(f"""
      SELECT event_id,
        count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {window} SECONDS PRECEDING AND CURRENT ROW) AS v,
        timestampdiff(DAY, min(ts) OVER (PARTITION BY user_id), ts) AS age,
        coalesce(avg(CASE WHEN event_type = 'error' THEN 1.0D ELSE 0.0D END) OVER (
          PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0D) AS rate
      FROM ev_hist""")
    got = {r.event_id: (r.interaction_velocity_5m, r.account_age_days, r.historical_report_rate) for r in ours.collect()}
    assert len(got) == events.count()
    for r in plain.collect():
        v, age, rate = got[r.event_id]
        assert (v, age) == (r.v, r.age)
        assert rate == pytest.approx(r.rate, abs=1e-12)


def test_history_with_a_hot_user(spark, events):
    """One user holding a third of the rows, with dense timestamps."""
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    ours = history_signals(hot, "user_id", "ts", "event_id", F.col("event_type") == "error", RuleConfig())
    hot.createOrReplaceTempView("ev_hot")
    plain = spark.sql("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS v FROM ev_hot""")
    got = {r.event_id: r.interaction_velocity_5m for r in ours.collect()}
    assert all(got[r.event_id] == r.v for r in plain.collect())


def test_exact_quantiles_match_pandas(spark, events):
    long = events.select(F.lit("value").alias("name"), F.col("value")).unionByName(
        events.select(F.lit("user").alias("name"), F.col("user_id").cast("double").alias("value")))
    got = {(r.name, r.p): r.value for r in exact_quantiles(long, (0.25, 0.5, 0.75)).collect()}
    pdf = events.select("value", "user_id").toPandas()
    for p in (0.25, 0.5, 0.75):
        assert got[("value", p)] == pytest.approx(pdf["value"].quantile(p), rel=1e-12)
        assert got[("user", p)] == pytest.approx(pdf["user_id"].astype(float).quantile(p), rel=1e-12)


def test_stratified_split_sizes(spark, events):
    df = events.select(F.col("event_id").alias("seq"), (F.col("event_type") == "error").cast("int").alias("label_risky_event"))
    split = stratified_split(df)
    sizes = {(r[0], r[1]): r[2] for r in split.groupBy("label_risky_event", "split").count().collect()}
    n = dict(df.groupBy("label_risky_event").count().collect())
    for label, total in n.items():
        assert sizes[(label, "test")] == max(1, round(total * 0.3))
        assert sizes[(label, "test")] + sizes[(label, "train")] == total


def test_null_users_and_times_are_rows_like_others(spark):
    rows = [(1, None, "2026-01-01 00:00:00", 1), (2, None, "2026-02-01 00:00:00", 0), (3, "u", None, 1), (4, "u", None, 0), (5, "u", "2026-01-01 00:00:00", 0)]
    df = spark.createDataFrame(rows, "event_id long, user_id string, t string, r int").withColumn("ts", F.col("t").try_cast("timestamp_ntz"))
    got = {r.event_id: (r.interaction_velocity_5m, r.account_age_days, r.historical_report_rate)
           for r in history_signals(df, "user_id", "ts", "event_id", F.col("r") == 1).collect()}
    assert got == {1: (1, 0, 0.0), 2: (1, 31, 1.0), 3: (2, None, 0.0), 4: (2, None, 1.0), 5: (1, 0, 0.5)}


def test_a_burst_of_one_user_costs_linear_time(spark):
    import time

    took = []
    for n in (8_000, 64_000):
        df = spark.range(n).select(F.col("id").alias("event_id"), F.lit(1).alias("user_id"),
                                   F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id % 250 as decimal(18,6)))").alias("ts"))
        t = time.perf_counter()
        assert history_signals(df, "user_id", "ts", "event_id", F.lit(False)).agg(F.max("interaction_velocity_5m")).first()[0] == n
        took.append(time.perf_counter() - t)
    assert took[1] < 8 * max(took[0], 1.0)


def test_null_groups_and_labels_keep_their_rows(spark, events):
    df = events.withColumn("event_type", F.when(F.col("event_id") % 3 > 0, F.col("event_type")))
    assert with_rank_within(df, "event_type", [F.col("event_id")], "r").count() == events.count()
    labelled = events.select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 3 > 0, F.lit(1)).alias("label_risky_event"))
    assert stratified_split(labelled).count() == events.count()


def test_correlation_of_columns_with_nulls_is_pairwise(spark, events):
    from eventsieve.operators.stats import correlation_matrix

    df = events.select(F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("a"), (F.col("value") * 2 + F.col("user_id")).alias("b"),
                       F.when(F.col("event_id") % 7 > 0, F.col("user_id").cast("double")).alias("c"), F.lit(1.0).alias("k"))
    got = {(r[0], r[1]): r[2] for r in correlation_matrix(df, ("a", "b", "c", "k")).collect()}
    expected = df.toPandas().corr()
    for (x, y), v in got.items():
        assert v is None if "k" in (x, y) else v == pytest.approx(expected.loc[x, y], abs=1e-9)


def test_only_the_result_stays_stored(spark):
    from eventsieve import session

    before = set(session._STORED)
    with session.only_result(spark) as keep:
        step = session.materialize(spark.range(10))
        out = keep(step.filter("id > 3"))
    assert set(session._STORED) - before == {out._stored_path} and out.count() == 6
    with pytest.raises(ValueError):
        with session.only_result(spark) as keep:
            keep(spark.range(3))
            session.materialize(spark.range(4))
            raise ValueError
    left = set(session._STORED) - before
    assert left == {out._stored_path}  # nothing of the second
    session.release(out)


def split_by_rank(rows, rules):
    """``{id: sorted splits}`` of ``(id, label)`` rows: per class the first rows in key order are test; equal ids are interchangeable."""
    import hashlib

    out, classes = {}, {}
    for i, label in rows:
        classes.setdefault(label, []).append("" if i is None else hashlib.md5(f"{i}|{rules.seed}".encode()).hexdigest())
    for label, keys in classes.items():
        k = max(1, round(len(keys) * rules.test_fraction))
        for rank, key in enumerate(sorted(keys)):
            out.setdefault((label, key), []).append("test" if rank < k else "train")
    return {key: sorted(v) for key, v in out.items()}


@pytest.mark.parametrize("ids", [list(range(400)), [i // 37 for i in range(400)], [None] * 400, [None if i % 3 else i for i in range(400)]])
def test_stratified_split_is_the_rank_order_of_keys(spark, ids):
    from eventsieve.config import DEFAULT_RULES
    from eventsieve.operators.scoring import split_key

    rows = [(i, (None, 0, 1, 1)[at % 4]) for at, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "seq long, label_risky_event int").withColumn("other", F.lit("x"))
    split = stratified_split(df)
    assert split.columns == [*df.columns, "split"]
    got = {}
    for r in split.withColumn("_k", F.coalesce(split_key("seq", DEFAULT_RULES.seed), F.lit(""))).collect():
        got.setdefault((r.label_risky_event, r["_k"]), []).append(r.split)
    assert {key: sorted(v) for key, v in got.items()} == split_by_rank(rows, DEFAULT_RULES)


def test_stratified_split_moves_and_stores_no_features(spark):
    """F1-F4: the features were sorted, stored and shuffled with all their columns."""
    import eventsieve.session as session

    df = session.materialize(spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 2).cast("int").alias("label_risky_event"), F.lit("x" * 200).alias("wide")))
    before = set(session._STORED)
    split = stratified_split(df)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert all("wide" not in spark.read.parquet(p).columns for p in session._STORED if p not in before)


def test_numbers_of_known_type_are_read_like_their_texts(spark):
    from eventsieve.functions.numeric import NUMBER_TYPES, parse_flag, parse_number

    rows = [(1, 2**53 + 1, 0.1), (-1, -7, float("nan")), (None, None, None), (0, 0, float("inf")), (2, 3, -0.0), (7, 9, 1e-300), (7, 2**62, 1.9)]
    df = spark.createDataFrame(rows, "i int, l long, d double")
    for c, kind in df.dtypes:
        assert kind in NUMBER_TYPES
        for read in (parse_number, parse_flag):
            plan = df.select(read(c, kind).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
            assert "RLIKE" not in plan.upper()  # numbers were written as text and read again
            got = df.select(read(c).alias("text"), read(c, kind).alias("known")).collect()
            assert all(repr(r.text) == repr(r.known) for r in got)


def test_seconds_are_formatted_alike_in_all_years(spark):
    from eventsieve.functions.timestamps import format_seconds

    texts = ["2024-01-30 23:59:25.261702", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999", "2024-02-29 00:00:00", None, "+10000-01-01 00:00:00", "-0005-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").try_cast("timestamp_ntz").alias("ts"))
    ts = F.col("ts")
    old = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts))
    assert all(r.old == r.new for r in df.select(old.alias("old"), format_seconds("ts").alias("new")).collect())


def test_the_model_job_runs_no_event_windows_twice(spark, monkeypatch):
    """events are stored once, as features without texts."""
    import eventsieve.session as session
    from eventsieve.operators import features
    from eventsieve.plans import catalog

    stored = []
    real = session.materialize
    monkeypatch.setattr(features, "materialize", lambda df: stored.append(df.columns) or real(df))
    monkeypatch.setattr(catalog, "materialize", lambda df: stored.append(df.columns) or real(df))
    catalog.q_bi_subjects(spark, SF_SMALL).collect()
    assert len([c for c in stored if "account_age_days" in c]) == 1 and not any("content" in c for c in stored)
