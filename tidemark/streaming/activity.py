"""Sessions and daily actives of a stream of events, with state that the watermark clears."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.sessions import gap_micros, session_columns, session_facts
from tidemark.session import require_utc


def _micros(span: timedelta) -> str:
    return f"{span // timedelta(microseconds=1)} microseconds"


def _timed(events: DataFrame, time: str, delay: timedelta) -> DataFrame:
    """Known users' events under a watermark, which takes times with a zone: UTC, as everywhere."""
    require_utc(events.sparkSession)
    known = events.where(F.col("user_id").isNotNull() & F.col(time).isNotNull())
    return known.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, _micros(delay))


def streamed_sessions(events: DataFrame, gap: timedelta, delay: timedelta, time: str = "created_at") -> DataFrame:
    """Sessions as ``sessionize`` makes them, each as soon as no event can join it any more.

    Events later than ``delay`` behind the newest one may be missing. State is one row per
    open session; runs of one micro-batch are merged in their tasks before the shuffle.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # The engine also merges an event that is exactly the window's gap later, which here opens a session.
    window = F.session_window(time, f"{gap_micros(gap) - 1} microseconds")
    found = _timed(events, time, delay).groupBy("user_id", window).agg(*session_facts(time))
    plain = [found[c].cast("timestamp_ntz").alias(c) if c in ("session_start", "session_end") else found[c] for c in found.columns]
    return found.select(*plain).select(*session_columns())


def streamed_actives(events: DataFrame, delay: timedelta, time: str = "created_at") -> DataFrame:
    """metric_date and dau_count as ``dau`` counts them, once a date is closed.

    Two keyed states: (date, user) pairs seen, and a count per date; both go when the
    watermark has passed the date. Dates without known users have no row.
    """
    seen = _timed(events, time, delay).select(F.window(time, "1 day").alias("day"), "user_id").dropDuplicates(["day", "user_id"])
    counted = seen.groupBy("day").agg(F.count(F.lit(1)).alias("dau_count"))
    return counted.select(F.to_date("day.start").alias("metric_date"), "dau_count")


def append_stream(rows: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends finished rows to a Parquet folder; a restart from the checkpoint adds nothing twice."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
