"""Every registered query against its SQL, over the whole smallest test tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.date().isoformat()
    return value.isoformat() if isinstance(value, date) else value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=str)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 4601


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = contract.queries()[name](spark, SMALL)
    expected = duck.sql(contract.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in found.schema.fields}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = ordered(found.select(*columns).collect())
    assert rows == ordered(expected.project(quoted).fetchall())
    assert rows
