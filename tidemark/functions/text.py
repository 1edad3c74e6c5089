"""Text normalization shared by several models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_platform(platform: Column) -> Column:
    """Free platform text -> ``ios`` / ``android`` / ``web``; the first match wins, NULL is web."""
    lowered = F.lower(platform)
    return (
        F.when(lowered.contains("ios"), "ios")
        .when(lowered.contains("android"), "android")
        .otherwise("web")
    )


def nonblank_or(value: Column, default: str | Column) -> Column:
    """``value`` unless it is NULL or the empty string."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def json_quote(text: Column) -> Column:
    """A string as a JSON string literal; NULL as ``null``."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    literal = F.regexp_extract(wrapped, r"(?s)^\{\"v\":(.*)\}$", 1)
    return F.when(text.isNull(), "null").otherwise(literal)


def threshold_band(value: Column, cuts: Sequence[float], names: Sequence[str]) -> Column:
    """The name of the band that ``value`` falls in; a cut belongs to the band above it."""
    if len(names) != len(cuts) + 1:
        raise ValueError("one more name than cuts is needed")
    band = None
    for cut, name in sorted(zip(cuts, names[1:]), reverse=True):
        band = F.when(value >= cut, name) if band is None else band.when(value >= cut, name)
    lowest = F.lit(names[0])
    return F.when(value.isNotNull(), band.otherwise(lowest) if band is not None else lowest)
