"""Posted events as a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import require_utc
from tidemark.sinks import read_ingested, store_ingested

__all__ = ["first_posts", "ingest_stream", "read_ingested"]


def first_posts(envelopes: DataFrame, within: timedelta) -> DataFrame:
    """A stream of envelopes without the repeats of a post (same endpoint and batch_id) that arrive within that time.

    The first to be read stays. State is one key per post and goes when the watermark on the
    time of arrival has passed it by ``within``; it lives in the checkpoint, so repeats are
    known after a restart as well. Posts without an id are known by their body.
    """
    require_utc(envelopes.sparkSession)
    keyed = envelopes.withColumns({"seen_at": F.col("arrival_ts").cast("timestamp"), "post": F.coalesce("batch_id", F.sha2("value", 256))})
    keyed = keyed.withWatermark("seen_at", f"{within // timedelta(microseconds=1)} microseconds")
    return keyed.dropDuplicatesWithinWatermark(["endpoint", "post"]).drop("seen_at", "post")


def ingest_stream(
    envelopes: DataFrame,
    out: str,
    quarantine: str,
    checkpoint: str,
    policy: str = "atomic",
    max_items: int | None = None,
    user_fallback: str = "blank",
    once: bool = False,
    repeats_within: timedelta | None = None,
) -> StreamingQuery:
    """Checks a stream of envelopes and adds stored events and quarantine rows.

    Bodies are parsed once per micro-batch. Rows lie by day of arrival, query and
    micro-batch; a micro-batch that runs again replaces its own rows, so a restart adds
    nothing twice, and other streams and loads into the same folders stay untouched. A new
    checkpoint is a new query. ``once`` handles what is there and stops; ``repeats_within``
    leaves out repeated posts.
    """
    names: list[str] = []

    def store(batch: DataFrame, epoch: int) -> None:
        if not names:  # the id of the query, the same after every restart from its checkpoint
            names.append(batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"])
        store_ingested(
            batch, out, quarantine, writer=names[0], epoch=epoch, policy=policy, max_items=max_items, user_fallback=user_fallback
        )

    rows = first_posts(envelopes, repeats_within) if repeats_within else envelopes
    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
