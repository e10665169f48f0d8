import duckdb
import pytest

from landgrid.llm import registry

SF = "/root/testdata/sf0.001"


def test_oracles_are_sql_for_known_queries():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert all(isinstance(sql, str) for sql in registry.ORACLES.values())


@pytest.mark.parametrize("name", ["op8_ngram_join", "quality_counts"])
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
