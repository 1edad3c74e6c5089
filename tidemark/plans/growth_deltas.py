"""Rolling actives kept by deltas: late events correct the windows ahead of them, and only their users are looked at.

Kept are layers of two small tables. ``words_n`` are bitmaps of active days per user, of
the events of one load only; the layers unite by OR. ``changes_n`` say by how much a load
moved the counts: per date how many more or fewer users are active, start or lapse in a
window, which is the work of ``activity_changes`` on the days of the load's users after
it, less the same before it. A count is the sum of all layers along the dates, so an event
of three weeks ago moves every window that it falls into, up to 30 days ahead. Nothing is
rewritten: the events and the rollup are not read again, and a layer has rows for its own
users and dates. Both tables of a load are released by one mark; a load that is run again
has bits that are there already and changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.activity import as_activity
from tidemark.operators.cohorts import MONDAY, WORD, activity_words, merge_words
from tidemark.operators.rolling import GROWTH_WINDOWS, activity_changes, by_date
from tidemark.session import written
from tidemark.sinks import read_release, release_all, stage_all

COUNTS = ["in_data", "dau_count", *GROWTH_WINDOWS]


def days_of(words: DataFrame) -> DataFrame:
    """(event_date, user_id) of bitmaps of days."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("bit_get", F.col("bits"), i) == 1)
    day = F.date_add(F.lit(MONDAY), (F.col("word") * WORD + F.col("bit")).cast("int"))
    return words.select("user_id", "word", F.explode(bits).alias("bit")).select(day.alias("event_date"), "user_id")


def _layers(release: Mapping[str, DataFrame], kind: str) -> dict[int, DataFrame]:
    return {int(name.rsplit("_", 1)[1]): df for name, df in release.items() if name.startswith(f"{kind}_")}


def add_activity(events: DataFrame, folder: str) -> int:
    """Adds the staged events (or rollup) of one load to the counts below ``folder``; returns the number of its layer.

    The load may hold any dates, late ones included, and events that were there before.
    One writer at a time.
    """
    spark = events.sparkSession
    release = read_release(spark, folder)
    stored = _layers(release, "words")
    fresh = written(activity_words(events, 1), "fresh-words")
    if stored:
        changed = fresh.select("user_id").distinct()
        before = written(merge_words(*stored.values()).join(changed, "user_id", "left_semi"), "words-before")
    else:
        before = fresh.limit(0)
    names = list(GROWTH_WINDOWS)
    after = activity_changes(days_of(merge_words(before, fresh)), GROWTH_WINDOWS).select("metric_date", "dau_count", *names)
    less = activity_changes(days_of(before), GROWTH_WINDOWS).select("metric_date", *((-F.col(c)).alias(c) for c in ["dau_count", *names]))
    # Dates whose events have no user are dates, too.
    dates = as_activity(events).where("event_date IS NOT NULL").select(F.col("event_date").alias("metric_date")).distinct()
    parts = dates.withColumn("in_data", F.lit(1)).unionByName(after, allowMissingColumns=True).unionByName(less, allowMissingColumns=True)
    changes = parts.groupBy("metric_date").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS))
    changes = changes.where(" OR ".join(f"{c} <> 0" for c in COUNTS))
    number = max(stored, default=0) + 1
    release_all(stage_all({f"words_{number}": fresh, f"changes_{number}": changes}, folder), folder)
    return number


def compact_layers(spark: SparkSession, folder: str) -> int:
    """Makes all layers one, under the newest one's next number, and returns how many there were."""
    release = read_release(spark, folder)
    words, changes = _layers(release, "words"), _layers(release, "changes")
    if len(words) <= 1:
        return len(words)
    number = max(words) + 1
    united = {f"words_{number}": merge_words(*words.values()), f"changes_{number}": _summed(changes)}
    release_all(stage_all(united, folder), folder, without=list(release))
    return len(words)


def _summed(changes: Mapping[int, DataFrame]) -> DataFrame:
    whole = None
    for layer in changes.values():
        whole = layer if whole is None else whole.unionByName(layer)
    return whole.groupBy("metric_date").agg(*(F.sum(c).alias(c) for c in COUNTS))


def rolling_counts(spark: SparkSession, folder: str) -> DataFrame:
    """metric_date, dau_count, wau_count and mau_count of every date with events, from the layers.

    A window runs over one row per date.
    """
    changes = _layers(read_release(spark, folder), "changes")
    if not changes:
        raise LookupError(f"no activity was added below {folder}")
    rolled = [F.sum(c).over(by_date()).cast("bigint").alias(c) for c in GROWTH_WINDOWS]
    return _summed(changes).select("metric_date", "in_data", "dau_count", *rolled).where("in_data > 0").drop("in_data")
