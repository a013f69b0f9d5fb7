"""Every query against its SQL twin in DuckDB, on whole tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from panelkit.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "null")
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float)):
        return ("num", float(value) + 0.0)
    return ("text", str(value))


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert found
        return
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    wanted = rows(expected.fetchall(), columns)
    got = rows(found, df.columns)
    assert len(got) == len(wanted)
    assert got == wanted
    kinds = {d[0]: str(d[1]) for d in expected.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    differing = {c: (t, kinds[c]) for c, t in df.dtypes if same.get(t) != kinds[c].upper()}
    assert not differing
