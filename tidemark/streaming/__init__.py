from tidemark.streaming.ingest import ingest_stream, read_ingested

__all__ = ["ingest_stream", "read_ingested"]
