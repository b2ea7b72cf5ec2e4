"""Every registered query against its SQL."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest

import __spark_entry__ as contract
from tidemark import workload

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def normal(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_sql():
    assert workload.QUERIES.keys() == workload.ORACLES.keys()
    assert workload.QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(name, spark, duck, both_plans):
    df = workload.QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(workload.ORACLES[name])
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    assert normal(df.columns, df.collect()) == normal(names, expected)
    assert expected


def test_flagship_runs(spark):
    assert contract.entry(spark).count() > 0
