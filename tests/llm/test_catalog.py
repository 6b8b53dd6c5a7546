"""The SQL of the training-data queries gives the result's types."""

import duckdb
import pytest

from eventsieve.llm import catalog
from tests.conftest import SF_SMALL

SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_result_types_match_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    rel = con.sql(catalog.oracle_sql()[name])
    want = dict(zip(rel.columns, [str(t) for t in rel.types], strict=True))
    fields = catalog.queries()[name](spark, SF_SMALL).schema.fields
    assert sorted(want) == sorted(f.name for f in fields)
    for f in fields:
        assert SPARK_TO_DUCKDB.get(f.dataType.simpleString()) == want[f.name], f.name


def test_queries_with_sql_are_registered():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
