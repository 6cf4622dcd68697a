"""Every registered query against its SQL on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck, sf):
    ours = QUERIES[name](spark, sf)
    columns = sorted(ours.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(tuple(cell(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(tuple(cell(row[c]) for c in columns) for row in ours.collect()) == expected


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"primary_genre", "success_class", "titles", "avg_revenue"} == set(rows[0].asDict())
