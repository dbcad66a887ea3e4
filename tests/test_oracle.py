"""Every registered query equals its SQL oracle at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402

from ledger_spark.plans import oracle, registry  # noqa: E402

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()
SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def database(small_folder):
    connection = duckdb.connect()
    for file in Path(small_folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, small_folder, database, name):
    frame = QUERIES[name](spark, small_folder)
    columns = sorted(frame.columns)
    cursor = database.execute(ORACLE[name])
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    order = [list(kinds).index(c) for c in columns]
    assert sorted(kinds) == columns
    assert {c: SPARK_TO_SQL[t] for c, t in frame.dtypes} == kinds

    def sort_key(row):
        return tuple((v is None, str(v)) for v in row)

    actual = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=sort_key)
    assert actual == sorted((tuple(r[i] for i in order) for r in expected), key=sort_key)
    assert actual


def test_entry_registers_the_library():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark, small_folder):
    assert entry_module.entry(spark).count() > 0
