"""Checked events and their quarantine."""

from __future__ import annotations

import re
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import ENVELOPE_SCHEMA, accepted_events, ingest_outcomes, rejected_events
from tidemark.sinks.tables import files

# Stored rows lie by day of arrival, and below that by the load or stream and the micro-batch that wrote them.
LAYOUT = ("arrival_date", "writer", "epoch")
WRITER = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
COMPACTED = "compacted"


def store_ingested(
    envelopes: DataFrame,
    out: str,
    quarantine: str,
    *,
    writer: str,
    epoch: int = 0,
    policy: str = "atomic",
    max_items: int | None = None,
    user_fallback: str = "blank",
) -> None:
    """Checks posted envelopes once and adds both results by day of arrival, few files per day.

    ``writer`` names the load (a stream: its query), ``epoch`` its micro-batch. What the same
    writer and epoch wrote for these days before is replaced, so a load that is run again
    adds nothing twice; rows of all others stay. So every load needs a name of its own.
    """
    if not WRITER.fullmatch(writer) or writer == COMPACTED:
        raise ValueError(f"not a name for a load: {writer!r}")
    outcomes = ingest_outcomes(envelopes, policy, max_items).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _write(accepted_events(outcomes, user_fallback), "created_at", out, writer, epoch)
        _write(rejected_events(outcomes), "arrival_ts", quarantine, writer, epoch)
    finally:
        outcomes.unpersist()


def _write(rows: DataFrame, arrival: str, path: str, writer: str, epoch: int) -> None:
    dated = rows.withColumns({"arrival_date": F.to_date(arrival), "writer": F.lit(writer), "epoch": F.lit(epoch).cast("bigint")})
    save = dated.hint("rebalance", "arrival_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    save.partitionBy(*LAYOUT).parquet(path)


def read_ingested(spark: SparkSession, path: str, rejected: bool = False) -> DataFrame:
    """All rows that were stored in one of the targets, even none.

    A filter on ``arrival_date`` reads only these days.
    """
    no_posts = ingest_outcomes(spark.createDataFrame([], ENVELOPE_SCHEMA), "lenient")
    schema = (rejected_events if rejected else accepted_events)(no_posts).schema
    for name, kind in zip(LAYOUT, ("date", "string", "long")):
        schema = schema.add(name, kind)
    return spark.read.schema(schema).parquet(path).drop("writer", "epoch")


def compact_ingested(spark: SparkSession, path: str, day: date, rejected: bool = False) -> int:
    """Makes the many folders of a closed day one, and returns how many there were.

    A day is closed when no load or stream writes or repeats rows of it any more: a repeat
    would add them again. The new folder is complete before the old one goes aside, and each
    step is one rename, so a call that broke off is finished by the next one; readers of
    this day should wait. A day with one folder is left as it is.
    """
    name = f"arrival_date={day.isoformat()}"
    here, fresh, aside = f"{path}/{name}", f"{path}/_fresh/{name}", f"{path}/_aside/{name}"
    fs, _ = files(spark, path)

    def there(folder: str) -> bool:
        return fs.exists(files(spark, folder)[1])

    def move(source: str, target: str) -> None:
        parent = files(spark, target)[1].getParent()
        fs.mkdirs(parent)
        if not fs.rename(files(spark, source)[1], files(spark, target)[1]):
            raise RuntimeError(f"{source} could not be moved to {target}")

    folders = 0
    if there(aside):  # an earlier call broke off after it had written all
        if not there(here):
            move(fresh, here)
    elif there(here):
        epochs = fs.globStatus(files(spark, f"{here}/writer=*/epoch=*")[1])
        folders = len(epochs)
        if folders <= 1:
            return folders
        rows = read_ingested(spark, path, rejected).where(F.col("arrival_date") == F.lit(day)).drop("arrival_date")
        size = sum(fs.getContentSummary(s.getPath()).getLength() for s in epochs)
        rows.repartition(max(1, size // (128 << 20))).write.mode("overwrite").parquet(f"{fresh}/writer={COMPACTED}/epoch=0")
        move(here, aside)
        move(fresh, here)
    fs.delete(files(spark, aside)[1], True)
    return folders
