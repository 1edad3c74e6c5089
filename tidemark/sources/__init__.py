from tidemark.sources.ga4 import ga4_normalize, union_event_sources
from tidemark.sources.jdbc import JdbcSource, read_jdbc_table
from tidemark.sources.tables import choose_tables, read_marts, read_parquet_raw

__all__ = [
    "JdbcSource",
    "choose_tables",
    "ga4_normalize",
    "read_jdbc_table",
    "read_marts",
    "read_parquet_raw",
    "union_event_sources",
]
