"""Saved pipelines (SNK-5), gradient steps (ML-4), trees as expressions (ML-6/16), the payload (SNK-8) and SQL functions."""

import csv
import os
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, FEATURE_COLUMNS, LABEL_COLUMN, MODEL_FOREST, REFERENCE_WEIGHTS
from eventsieve.functions.hashing import pseudonymize
from eventsieve.functions.timestamps import parse_timestamp
from eventsieve.operators import features, models, scoring, stats
from eventsieve.operators.feed import payload_lines, read_section, rows_from_json, write_payload
from eventsieve.operators.gradient import GradientConfig, fit_by_gradient, weighted_vectors
from eventsieve.operators.model_stages import PROBABILITY, scoring_pipeline
from eventsieve.operators.rules import decision_rule_reason, etl_error_reason
from eventsieve.operators.trees import STORED_FOREST, Split, forest_column, score_forest, tree_column, trees_of
from eventsieve.plans import sql_functions
from eventsieve.plans.modeling import load_scoring_pipeline
from eventsieve.session import materialize
from eventsieve.sources.driver_tables import dirty_signals, model_events, raw_events
from tests.conftest import REFERENCE_DATA, SF_SMALL


@pytest.fixture(scope="module")
def raw_model(spark):
    return materialize(model_events(spark, SF_SMALL))


@pytest.fixture(scope="module")
def split(spark, raw_model):
    return materialize(scoring.stratified_split(features.engineer_features(raw_model)))


def probabilities(df):
    return {r.seq: r[PROBABILITY] for r in df.select("seq", PROBABILITY).collect()}


# --- saved pipelines ---------------------------------------------------------------------------------------------


def test_reloaded_linear_pipeline_scores_raw_rows(spark, raw_model, tmp_path):
    medians = {"account_age_days": 7.5, "interaction_velocity_5m": 2.0, "historical_report_rate": 0.25}
    made = scoring_pipeline(medians, linear=scoring.REFERENCE_MODEL)
    made.write().save(str(tmp_path / "m"))
    back = load_scoring_pipeline(str(tmp_path / "m"))
    dirty = dirty_signals(raw_events(spark, SF_SMALL))  # signals that cannot be read take the saved medians
    expected = features.engineer_features(dirty, medians=medians).withColumn(PROBABILITY, scoring.REFERENCE_MODEL.probability())
    assert probabilities(back.transform(dirty)) == probabilities(made.transform(dirty)) == probabilities(expected)
    scored = back.transform(raw_model)
    assert [r.event_type for r in scored.orderBy("seq").select("event_type").collect()] == [r.event_type for r in raw_model.orderBy("seq").select("event_type").collect()]
    assert back.stages[-1].model() == scoring.REFERENCE_MODEL


def test_reloaded_forest_pipeline_scores_raw_rows(spark, raw_model, split, tmp_path):
    rules = DEFAULT_RULES.__class__(forest_trees=5, forest_max_depth=4)
    fitted = models.fit_forest(models.assemble(split.filter("split = 'train'")), rules)
    path = str(tmp_path / "f")
    scoring_pipeline(features.signal_medians(raw_model), classifier=fitted.model).write().save(path)
    got = load_scoring_pipeline(path).transform(raw_model)
    assert "features" not in got.columns and "rawPrediction" not in got.columns
    expected = models.predict(models.FittedCandidate(MODEL_FOREST, fitted.model, 0.0), models.assemble(split))
    assert probabilities(got) == pytest.approx(probabilities(expected), abs=1e-12)


def test_baseline_pipeline_gives_its_constant(spark, raw_model, tmp_path):
    path = str(tmp_path / "c")
    scoring_pipeline({}, constant=0.375).write().save(path)
    assert {r[0] for r in load_scoring_pipeline(path).transform(raw_model).select(PROBABILITY).distinct().collect()} == {0.375}


# --- gradient steps ----------------------------------------------------------------------------------------------


def plain_steps(x, y, config):
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(config.steps):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y)
        g[1:] += config.l2 * w[1:] / len(y)
        w = w - config.learning_rate * g
    return w


@pytest.mark.parametrize("local_vectors", [0, 10_000])
def test_steps_equal_plain_ones(spark, split, local_vectors):
    train = split.filter("split = 'train'")
    config = GradientConfig(steps=5, local_vectors=local_vectors)
    model = fit_by_gradient(train, config)
    rows = np.array([[float(v) for v in r] for r in train.select(*FEATURE_COLUMNS, LABEL_COLUMN).collect()])
    x = rows[:, :-1]
    std = x.std(0)
    expected = plain_steps((x - x.mean(0)) / np.where(std == 0, 1, std), rows[:, -1], config)
    assert [model.intercept, *model.weights] == pytest.approx(expected.tolist(), abs=1e-9)


def test_equal_rows_are_one_weighted_vector(spark):
    one = spark.createDataFrame([(1.0, 0), (1.0, 0), (2.0, 1), (1.0, 1)], "a double, y int")
    assert sorted(tuple(r) for r in weighted_vectors(one, ("a",), "y").collect()) == [(1.0, 0.0, 2), (1.0, 1.0, 1), (2.0, 1.0, 1)]
    many = one.unionByName(one).unionByName(one)
    for local in (0, 100):
        config = GradientConfig(steps=20, l2=0.0, local_vectors=local)
        assert fit_by_gradient(many, config, ("a",), "y").weights == pytest.approx(fit_by_gradient(one, config, ("a",), "y").weights, abs=1e-12)


def test_no_rows_leave_all_weights_at_zero(spark):
    model = fit_by_gradient(spark.createDataFrame([], "a double, y int"), GradientConfig(steps=3), ("a",), "y")
    assert (model.intercept, model.weights) == (0.0, (0.0,))


@pytest.mark.skipif(not os.path.isdir(REFERENCE_DATA), reason="published files not present")
def test_published_weights_come_out_of_the_published_rows(spark):
    """The published split is a shuffle of its own; the rows whose statistics are the published ones are found by them."""
    with open(os.path.join(REFERENCE_DATA, "ai/feature_matrix.csv"), newline="", encoding="utf-8") as f:
        rows = [tuple(float(r[c]) for c in [*FEATURE_COLUMNS, LABEL_COLUMN]) for r in csv.DictReader(f)]
    # The published split, from its documented rule: per class a seeded permutation, the first 30 % are test rows.
    rng, train = np.random.default_rng(42), []
    for label in (0.0, 1.0):
        own = np.array([i for i, r in enumerate(rows) if r[-1] == label])
        rng.shuffle(own)
        train += own[max(1, round(len(own) * 0.3)) :].tolist()
    df = spark.createDataFrame([rows[i] for i in train], ", ".join(f"{c} double" for c in [*FEATURE_COLUMNS, LABEL_COLUMN]))
    model = fit_by_gradient(df)
    assert len(train) == 140
    assert [model.intercept, *model.weights] == pytest.approx(list(REFERENCE_WEIGHTS), abs=1e-6)


# --- trees as expressions ----------------------------------------------------------------------------------------


def walk(tree, row):
    while isinstance(tree, Split):
        v = row[tree.feature]
        tree = tree.low if v is not None and float(v) <= tree.threshold else tree.high
    return tree


def test_stored_forest_equals_a_walk(spark, split):
    for r in score_forest(split, STORED_FOREST).collect():
        assert r[PROBABILITY] == pytest.approx(sum(walk(t, r) for t in STORED_FOREST) / len(STORED_FOREST), abs=1e-12)


def test_nulls_go_high_and_a_leaf_is_a_tree(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,)], "a double")
    assert [r[0] for r in df.select(tree_column(Split("a", 1.0, 0.1, 0.9))).collect()] == [0.9, 0.1, 0.9]
    assert df.select(forest_column([0.25, 0.75])).first()[0] == 0.5


def test_fitted_forest_as_an_expression_gives_its_probabilities(spark, split):
    rules = DEFAULT_RULES.__class__(forest_trees=12, forest_max_depth=5)
    fitted = models.fit_forest(models.assemble(split.filter("split = 'train'")), rules)
    trees = trees_of(spark, fitted.model)
    assert len(trees) == 12
    expected = probabilities(models.predict(fitted, models.assemble(split)))
    scored = score_forest(split, trees)
    assert probabilities(scored) == pytest.approx(expected, abs=1e-12)


# --- the payload -------------------------------------------------------------------------------------------------


def test_payload_round_trip(spark, tmp_path):
    odd = 'quote " back \\ line\n ü   end'
    a = spark.createDataFrame([("x", 1.5, odd, None), (None, None, "", 3)], "k string, v double, t string, n int")
    b = spark.createDataFrame([(True,)], "flag boolean")
    path = str(tmp_path / "p")
    write_payload(payload_lines({"a": a, "b": b, "empty": a.limit(0)}), path)
    schema = "k string, v double, t string, n int"
    key = lambda r: str(tuple(r))
    assert sorted(read_section(spark, path, "a", schema).collect(), key=key) == sorted(a.collect(), key=key)
    assert [r.flag for r in read_section(spark, path, "b", {"flag": "boolean"}).collect()] == [True]
    assert read_section(spark, path, "empty", schema).count() == 0 and read_section(spark, path, "other", schema).count() == 0


def test_bad_json_and_wrong_types_give_nulls_or_no_row(spark):
    texts = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no number"}',), ("not json",), (None,), ("[]",), ('{"a": 2.0}',)], "line string")
    got = [tuple(r) for r in rows_from_json(texts, "line", "a int, b string").collect()]
    assert sorted(got, key=str) == sorted([(1, "x"), (None, None), (None, None), (2, None)], key=str)
    with pytest.raises(ValueError):
        payload_lines({})


# --- SQL functions -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def registered(spark):
    return sql_functions.register(spark)


def shape(df):
    """The optimised plan's expressions, without ids and names of their own."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString())


def test_functions_give_what_the_operators_give(spark, raw_model, registered):
    odd = ["", " ", None, "nan", " NaN ", "u1", " u2 ", "x'y", "\\", "\t"]
    times = ["2024-01-02", "2024-01-02 03:04:05.678", "2024-1-2", " 2024-01-02T03:04 ", "fecha", None, "2024-02-30", "2024-03-10 02:30:00"]
    rows = [(i, a, b, t, ["like", " LIKE ", "x", None][i % 4], i % 2) for i, (a, b, t) in enumerate((a, b, t) for a in odd for b in odd for t in times)]
    df = spark.createDataFrame(rows, "seq int, source_user_id string, target_user_id string, created_at string, event_type string, is_duplicate int").withColumn("event_id", F.col("source_user_id"))
    view = f"v_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    sql = spark.sql(f"""SELECT es_rule_reason(event_id, event_type, source_user_id, target_user_id, created_at, is_duplicate) AS r, es_pseudonym(source_user_id, 's') AS p,
                        es_event_time(created_at) AS t, es_error_reason(event_id, event_type, source_user_id, target_user_id, es_event_time(created_at)) AS e FROM {view}""")
    own = df.withColumn("raw_time", F.col("created_at")).withColumn("r", decision_rule_reason()).withColumn("created_at", parse_timestamp("created_at")).select(
        "r", pseudonymize("source_user_id", "s").alias("p"), F.col("created_at").alias("t"), etl_error_reason().alias("e"))
    assert [tuple(x) for x in sql.collect()] == [tuple(x) for x in own.collect()]


def test_functions_plan_to_expressions(spark, raw_model, registered):
    view = f"v_{uuid.uuid4().hex}"
    raw_model.createOrReplaceTempView(view)
    sql = spark.sql(f"SELECT es_pseudonym(source_user_id, 's') AS k FROM {view}")
    own = raw_model.select(pseudonymize("source_user_id", "s").alias("k"))
    for df in (sql, own):
        assert "UDF" not in shape(df) and "usr_" in shape(df) and "sha2" in shape(df).lower()
    assert shape(sql).count("Project") == shape(own).count("Project") == 1
    assert [r.k for r in sql.collect()] == [r.k for r in own.collect()]


def test_scorer_in_sql_equals_the_expression(spark, split, registered):
    view = f"v_{uuid.uuid4().hex}"
    split.createOrReplaceTempView(view)
    sql = {r[0]: r[1] for r in spark.sql(f"SELECT seq, es_risk({', '.join(FEATURE_COLUMNS)}) FROM {view}").collect()}
    own = {r[0]: r[1] for r in split.select("seq", scoring.REFERENCE_MODEL.probability()).collect()}
    assert sql == pytest.approx(own, abs=1e-14)


def test_table_function_over_cleaned_events(spark, registered):
    from eventsieve.operators.cleaning import clean_transform
    from eventsieve.operators.rules import validate_events

    cleaned = clean_transform(raw_events(spark, SF_SMALL))
    cleaned.createOrReplaceTempView("cleaned_for_sql")
    name = sql_functions.register_table_function(spark, "cleaned_for_sql")
    rejected = validate_events(cleaned)[1]
    got = sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {name}('fecha')").collect())
    assert got == sorted((r.seq, r.event_id, r.error_reason) for r in rejected.collect() if "fecha" in r.error_reason) and got
    assert spark.sql(f"SELECT * FROM {name}('')").count() == rejected.count()


def test_literals_keep_any_text(spark):
    for text in ("it's", 'a"b', "back\\slash", "ñ   %", "$x{y}", ""):
        assert spark.sql(f"SELECT {sql_functions.literal(text)}").first()[0] == text


def test_quality_summary_survives_the_feed(spark, split, tmp_path):
    path = str(tmp_path / "q")
    quality = stats.quality_summary(split)
    write_payload(payload_lines({"quality": quality}), path)
    back = read_section(spark, path, "quality", "indicator string, value double, text_value string, position int")
    key = lambda r: r["indicator"]
    assert [tuple(r) for r in sorted(back.collect(), key=key)] == [tuple(r) for r in sorted(quality.select("indicator", "value", "text_value", "position").collect(), key=key)]
