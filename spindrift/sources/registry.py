"""The engine's own tables: their columns, creation, removal and verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.sinks import Table
from ..params import HORIZONS
from .files import schema_faults

#: Columns of every table, by name.
TABLES = {
    "runs": "tenant_id string, run_id string, status string, updated_at timestamp",
    "params": "tenant_id string, param_name string, value double",
    "forecasts": "tenant_id string, run_id string, sku string, model string, pattern string, tier string, status string, risk string, confidence double, mape double, " + ", ".join(f"p{q}_{h}d double" for h in HORIZONS for q in (50, 80, 90)),
    "fingerprints": "tenant_id string, sku string, fingerprint string, pattern string, total double",
    "thompson_state": "tenant_id string, sku string, model string, config_hash string, alpha double, beta double, trials bigint",
    "assessments": "tenant_id string, run_id string, total bigint, cache_hits bigint, partials bigint, fulls bigint, pct_auto double, pct_review double, avg_confidence double, fallbacks bigint, high_fallback boolean, low_cache_hit boolean, low_success boolean",
}


def schema(spark: SparkSession, name: str) -> StructType:
    return spark.createDataFrame([], TABLES[name]).schema


def up(spark: SparkSession, root: str) -> list[str]:
    """Create the tables that are not there, empty; their names."""
    made = [n for n in TABLES if Table(spark, f"{root}/{n}").read() is None]
    for n in made:
        Table(spark, f"{root}/{n}").write(spark.createDataFrame([], TABLES[n]))
    return made


def down(spark: SparkSession, root: str) -> None:
    """Remove all tables."""
    for n in TABLES:
        Table(spark, f"{root}/{n}").drop()


def faults(spark: SparkSession, have: dict[str, DataFrame | None], want: dict[str, str]) -> DataFrame:
    """(table_name, fault) of tables that are missing, lack columns or have columns of other types."""
    rows = []
    for name, ddl in want.items():
        df = have.get(name)
        rows += [(name, f) for f in (["missing table"] if df is None else schema_faults(df, spark.createDataFrame([], ddl).schema))]
    return spark.createDataFrame(rows, "table_name string, fault string")


def verify(spark: SparkSession, root: str) -> DataFrame:
    return faults(spark, {n: Table(spark, f"{root}/{n}").read() for n in TABLES}, TABLES)
