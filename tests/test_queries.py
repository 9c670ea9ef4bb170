"""Every registered query against its SQL in DuckDB, on the given tables."""

import math
from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry
from docledger import registry

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def _sorted(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in (DATA / "sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, str(DATA / "sf0.001"))
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    wanted = [[row[i] for i in order] for row in cursor.fetchall()]
    assert sorted(got.columns) == columns
    found = [tuple(row) for row in got.select(*columns).collect()]
    assert found
    assert _sorted(found) == _sorted(wanted)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry.queries())


def test_flagship_count(spark):
    assert entry.queries()["worklist"](spark, str(DATA / "sf0.01")).count() == 11_184


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "auth_request_id", "document_id", "ar_number", "full_path", "retry_count",
        "reprocess_success"]
