"""Copying the source tables: choose, read, write snapshots, register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks import register_raw, write_snapshots
from tidemark.sources import JdbcSource, choose_tables, read_jdbc_table
from tidemark.sources.jdbc import hash_split, id_split

# How each database lists its tables.
TABLE_LISTS = {
    "mysql": "(SELECT table_name AS name FROM information_schema.tables WHERE table_schema = DATABASE()) tables_here",
    "postgresql": (
        "(SELECT table_name AS name FROM information_schema.tables "
        "WHERE table_schema = current_schema() AND table_type = 'BASE TABLE') tables_here"
    ),
}


def list_tables(spark: SparkSession, source: JdbcSource) -> list[str]:
    names = spark.read.format("jdbc").options(**source.options(), dbtable=TABLE_LISTS[source.dialect]).load()
    return [row[0] for row in names.collect()]


def read_whole(spark: SparkSession, source: JdbcSource, table: str) -> DataFrame:
    """A table read by many tasks: by ranges of a numeric id (dense or not), by a hash of another id, by one task without an id."""
    kind = dict(read_jdbc_table(spark, source, table).dtypes).get("id")
    if kind is None:
        return read_jdbc_table(spark, source, table)
    numeric = kind in ("int", "bigint", "smallint") or kind.startswith("decimal")
    return read_jdbc_table(spark, source, table, split=(id_split if numeric else hash_split)(spark, source, table))


def extract(
    spark: SparkSession,
    source: JdbcSource,
    folder: str,
    configured: str | None = None,
    available: Callable[[SparkSession, JdbcSource], list[str]] = list_tables,
    read: Callable[[SparkSession, JdbcSource, str], DataFrame] = read_whole,
) -> dict[str, str]:
    """Snapshots of the chosen tables below ``folder``, registered as ``raw_<table>``.

    ``configured`` is a comma list that overrides the choice. A table that fails
    is left out; if none could be copied the run fails.
    """
    tables = choose_tables(configured, [] if configured else available(spark, source))
    loads = {table: (lambda table=table: read(spark, source, table)) for table in tables}
    written = write_snapshots(loads, folder)
    if not written:
        raise RuntimeError(f"no table could be copied from {source.host}/{source.database}")
    register_raw(spark, written)
    return written
