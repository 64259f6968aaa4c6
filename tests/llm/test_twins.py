"""SQL twins of the operators against the operators, over whole tables."""

import duckdb
import pytest

from heddle.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op8_suffix_dedup", "op9_ngram_join"])
def test_equals_its_twin(spark, name):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
        twin = db.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in twin.description]
        wanted = sorted(twin.fetchall())
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == wanted and wanted
