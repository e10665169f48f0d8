"""Every registered query of the record engine against its SQL, on the smallest tables."""

import duckdb
import pytest

from landgrid.plans import catalog

SF = "/root/testdata/sf0.001"
SLOW: set[str] = set()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("orders", "documents", "events", "customer"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in SLOW])
def test_query(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows or name in catalog.ORACLES
    if name in catalog.ORACLES:
        want = oracle.sql(catalog.ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        got = sorted((tuple(plain(r[c]) for c in want.columns) for r in rows), key=str)
        assert got == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=str)


def test_cascade_keeps_every_record(spark):
    from landgrid.plans.views import view

    rows = catalog.QUERIES["q_resolve_all"](spark, SF).collect()
    stems = [r.stem for r in rows]
    assert len(stems) == len(set(stems)) == view(spark, SF, "records").count()
    assert all((r.lat is None) == (r.lon is None) for r in rows)


def test_no_python_and_no_cartesian_product_in_the_cascade(spark):
    plan = catalog.QUERIES["q_resolve_p1"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
