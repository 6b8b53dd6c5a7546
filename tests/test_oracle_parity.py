"""Every SQL-checked query equals its DuckDB oracle on the sf0.001 tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from eventsieve.plans.catalog import ROWS_ONLY, SQL_CHECKED
from eventsieve.plans.oracle_sql import oracle_queries
from tests.conftest import SF_SMALL

FAST = ["clean_events", "duplicate_flags", "rejected_events", "notifications", "kpi_report", "recent_by_type",
        "velocity", "account_age", "report_rate", "risk_label", "feature_matrix", "quality_summary",
        "stratified_split", "model_metrics", "roc_curve", "final_decisions", "review_top", "pseudonymized_export",
        "measured_run", "table_lookups", "reloaded_scores", "feature_contributions", "gradient_weights", "forest_expression_scores",
        "feed_round_trip", "sql_function_decisions", "bi_subjects"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_result_types_match_oracle(spark, con, name):
    rel = con.sql(oracle_queries()[name])
    want = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in SQL_CHECKED[name](spark, SF_SMALL).schema.fields:
        assert SPARK_TO_DUCKDB.get(f.dataType.simpleString()) == want[f.name], f.name


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = SQL_CHECKED[name](spark, SF_SMALL)
    cur = con.execute(oracle_queries()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in sdf.columns]
    got = Counter(tuple(_norm(v) for v in r) for r in sdf.collect())
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_every_sql_query_has_an_oracle():
    assert set(oracle_queries()) == set(SQL_CHECKED)
    assert set(ROWS_ONLY) == {
        "logistic_model", "random_forest_model", "model_comparison", "feature_weights", "top_features",
        "all_event_decisions"}
    assert set(SQL_CHECKED) | set(ROWS_ONLY) <= set(entry.queries()) and set(oracle_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    assert entry.entry(spark).count() == 1
