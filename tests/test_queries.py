"""Every registered query against its checking SQL on the small tables."""

import duckdb
import pandas as pd
import pytest

from spindrift.plans import queries as Q

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if hasattr(v, "year"):
            return str(pd.Timestamp(v))
        return f"{float(v):.6f}" if isinstance(v, (int, float, bool)) or hasattr(v, "dtype") or type(v).__name__ == "Decimal" else str(v)

    return sorted(tuple(map(one, row)) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_matches_sql(spark, duck, name):
    got, want = Q.QUERIES[name](spark, DATA).toPandas(), duck.sql(Q.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE) - {"forecast_run"}))
def test_without_sql_is_stable(spark, name):
    a, b = (Q.QUERIES[name](spark, DATA).toPandas() for _ in range(2))
    assert len(a) and plain(a) == plain(b)


def test_forecast_run_invariants(spark):
    f = Q.forecast_run(spark, DATA).toPandas()
    assert f["sku"].is_unique and f["confidence"].between(0.3, 0.95).all()
    for h in (7, 30, 365):
        assert (f[f"p50_{h}d"] <= f[f"p90_{h}d"] + 1e-9).all()
    assert (f["p50_7d"] <= f["p50_365d"] + 1e-9)[f["model"] != "holts_linear_trend"].mean() > 0.9
    assert set(f["tier"]) <= {"auto_proceed", "review_suggested", "review_required", "manual_override"}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 25
    assert set(e.oracle_sql()) <= set(e.queries())
