"""Time text as zone-free UTC time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def event_time(text: Column) -> Column:
    """ISO text with a date -> UTC time; NULL if it is no time.

    Text without a zone is UTC. The session's own zone plays no part.
    """
    dated = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.trim(text))
    dated = F.regexp_replace(dated, r"^(.{10}[T ]\d{2}:\d{2})(Z|z|[+-]\d{2}:?\d{2})?$", "$1:00$2")
    zoned = F.when(dated.rlike(r":.*\d(Z|z|[+-]\d{2}:?\d{2})$"), dated)
    as_utc = F.concat(dated, F.when(dated.contains(":"), "Z").otherwise("T00:00:00Z"))
    instant = F.try_to_timestamp(F.when(text.rlike(ISO_TIME), text).otherwise(F.coalesce(zoned, as_utc)))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def utc_time(column: Column) -> Column:
    """A time column of any type: text by the rule of ``event_time``, other types by a cast.

    Text that is no time stops the query, as a cast would; the type is known when the
    query is planned, so a column of times stays a plain column for the scan.
    """
    text = column.cast("string")
    plain = column.cast("timestamp_ntz")
    return F.when(F.typeof(column) == "string", F.coalesce(event_time(text), text.cast("timestamp_ntz"))).otherwise(plain)
