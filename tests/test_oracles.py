"""Every registered query against its SQL, as bags of rows."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracles import ORACLES
from workload.queries import QUERIES, TABLES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items()
    assert ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    found = queries()[name](spark, SF_DIR)
    actual = bag(found.columns, [tuple(row) for row in found.collect()])
    result = duck.execute(oracle_sql()[name])
    expected = bag([d[0] for d in result.description], result.fetchall())
    assert actual[0] == expected[0]
    assert sum(actual[1].values()) == sum(expected[1].values()) > 0
    assert actual[1] == expected[1]


def test_entry_is_the_flagship_query(spark):
    connection = duckdb.connect()
    for name in ("customer", "orders", "events"):
        path = f"/root/testdata/sf0.001/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    expected = connection.execute(oracle_sql()["resolve_paths_window"]).fetchall()
    assert Counter(map(tuple, entry(spark).collect())) == Counter(expected) != Counter()
