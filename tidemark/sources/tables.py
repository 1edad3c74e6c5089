"""Which tables to read, and reading them from Parquet or the catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import RAW_SCHEMAS, ddl_columns, require_columns
from tidemark.sinks.tables import read_published, read_release

# The standard source tables in order, and the published ones.
STANDARD_TABLES = ["users", "analytics_events", "transactions"]
MARTS = ["mart_user_growth", "mart_event_funnel", "mart_revenue", "mart_platform_split"]


def choose_tables(configured: str | None, available: Iterable[str]) -> list[str]:
    """A configured comma list, else the standard tables present, else all present."""
    if configured:
        return [name.strip() for name in configured.split(",") if name.strip()]
    present = list(available)
    return [name for name in STANDARD_TABLES if name in present] or present


def read_parquet_raw(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A raw table; with its standard name the needed columns are checked."""
    df = spark.read.parquet(path)
    if table in RAW_SCHEMAS:
        require_columns(df, ddl_columns(RAW_SCHEMAS[table]), f"raw table {table!r} at {path}")
    return df


def read_marts(
    spark: SparkSession, require_all: bool, database: str | None = None, path: str | None = None
) -> Mapping[str, DataFrame]:
    """Published tables by name: those below the folder ``path``, in any session and of one release, else those of the catalog.

    ``require_all`` raises if any is missing (report page); otherwise the ones
    that exist are returned (metric samples). Nothing is ever made up.
    """
    if path is not None:
        together = read_release(spark, path)
        stored = {name: together.get(name) or read_published(spark, f"{path}/{name}") for name in MARTS}
        found = {name: df for name, df in stored.items() if df is not None}
    else:
        prefix = f"{database}." if database else ""
        found = {name: spark.table(prefix + name) for name in MARTS if spark.catalog.tableExists(prefix + name)}
    missing = [name for name in MARTS if name not in found]
    if require_all and missing:
        raise LookupError(f"missing published table(s): {', '.join(missing)}")
    return found
