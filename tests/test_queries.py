import math
import os

import duckdb
import pytest

from heddle.operators import queries_agg, queries_join, queries_scan, registry  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events embeddings".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def shown(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_twin(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    rows, columns = df.collect(), sorted(df.columns)
    if name not in registry.TWINS:
        assert rows
        return
    twin = duck.execute(registry.TWINS[name])
    names = [d[0] for d in twin.description]
    expected = twin.fetchall()
    assert sorted(names) == columns
    assert sorted([shown(r[c]) for c in columns] for r in rows) == sorted([shown(r[names.index(c)]) for c in columns] for r in expected)
