"""Every registered query against its SQL in DuckDB, over the smallest given tables."""

import datetime
import decimal
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(SF_DIR) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 12


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns, got = bag(result.columns, result.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    answer = duck.execute(entry.oracle_sql()[name])
    want_columns, want = bag([d[0] for d in answer.description], answer.fetchall())
    assert columns == want_columns
    extra, lacking = got - want, want - got
    assert not extra and not lacking, (len(extra), len(lacking), list(extra)[:3], list(lacking)[:3])
    assert want, "a comparison of nothing proves nothing"
