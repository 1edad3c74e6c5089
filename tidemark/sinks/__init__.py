from tidemark.sinks.ingested import compact_ingested, read_ingested, store_ingested
from tidemark.sinks.tables import (
    materialize_mart,
    read_published,
    read_release,
    register_raw,
    release_all,
    stage_all,
    stage_mart,
    write_snapshot,
    write_snapshots,
)
from tidemark.sinks.text import write_dashboard_json, write_text

__all__ = [
    "compact_ingested",
    "materialize_mart",
    "read_ingested",
    "read_published",
    "read_release",
    "register_raw",
    "release_all",
    "stage_all",
    "stage_mart",
    "store_ingested",
    "write_dashboard_json",
    "write_snapshot",
    "write_snapshots",
    "write_text",
]
