"""Queries on stored samples (metric, labels, value, ts_ms), as dashboards ask them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import label_text

AGGREGATES = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}


def metric_select(
    samples: DataFrame, name: str, match: Mapping[str, str] | None = None
) -> DataFrame:
    """Samples of one metric whose labels equal ``match``; a missing label counts as ''."""
    chosen = samples.where(F.col("metric") == name)
    for label, value in (match or {}).items():
        chosen = chosen.where(F.coalesce(F.col("labels")[label], F.lit("")) == value)
    return chosen


def with_series(samples: DataFrame) -> DataFrame:
    return samples.withColumn("series", label_text(F.col("labels"), escape=True))


def metric_instant(
    samples: DataFrame, name: str, match: Mapping[str, str] | None = None, at: int | None = None
) -> DataFrame:
    """(series, labels, value, ts_ms): the latest sample per series, up to ``at``."""
    chosen = metric_select(samples, name, match)
    if at is not None:
        chosen = chosen.where(F.col("ts_ms") <= at)
    newest = F.max_by(F.struct("labels", "value", "ts_ms"), "ts_ms")
    return (
        with_series(chosen)
        .groupBy("series")
        .agg(newest.alias("newest"))
        .select("series", "newest.labels", "newest.value", "newest.ts_ms")
    )


def metric_range(
    samples: DataFrame,
    name: str,
    start_ms: int | None = None,
    end_ms: int | None = None,
    legend: str | None = None,
    match: Mapping[str, str] | None = None,
) -> DataFrame:
    """(legend, series, ts_ms, value) in a time range, both ends included.

    ``legend`` is text with ``{{label}}`` in it; without one the series is its name.
    """
    chosen = with_series(metric_select(samples, name, match))
    if start_ms is not None:
        chosen = chosen.where(F.col("ts_ms") >= start_ms)
    if end_ms is not None:
        chosen = chosen.where(F.col("ts_ms") <= end_ms)
    shown = F.col("series") if legend is None else legend_text(legend)
    return chosen.select(shown.alias("legend"), "series", "ts_ms", "value")


def legend_text(legend: str) -> Column:
    parts: list[Column] = []
    for i, piece in enumerate(legend.replace("}}", "{{").split("{{")):
        parts.append(F.lit(piece) if i % 2 == 0 else F.coalesce(F.col("labels")[piece.strip()], F.lit("")))
    return F.concat(*parts)


def metric_agg(
    samples: DataFrame,
    name: str,
    fn: str,
    by: Sequence[str] = (),
    match: Mapping[str, str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """(ts_ms, <by labels>, value): one aggregate per timestamp and label group.

    ``where`` filters samples by value first, so ``avg`` of ``value > 0`` leaves
    out zero samples; a timestamp without any sample left has no row.
    """
    chosen = metric_select(samples, name, match)
    if where is not None:
        chosen = chosen.where(where)
    groups = [F.coalesce(F.col("labels")[label], F.lit("")).alias(label) for label in by]
    return chosen.groupBy("ts_ms", *groups).agg(AGGREGATES[fn]("value").alias("value"))


def metric_scale(vector: DataFrame, factor: float) -> DataFrame:
    return vector.withColumn("value", F.col("value") * F.lit(float(factor)))


def bottomk(samples: DataFrame, name: str, k: int = 1) -> DataFrame:
    """The k smallest series per timestamp (a ranking report); ties go by series text."""
    smallest = W.partitionBy("ts_ms").orderBy("value", "series")
    return (
        with_series(metric_select(samples, name))
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= k)
        .select("series", "labels", "ts_ms", "value")
    )


def metric_ratio(samples: DataFrame, part: str, whole: str, scale: float = 1.0) -> DataFrame:
    """(series, ts_ms, value): ``part / (whole > 0)`` for equal label sets and times.

    A series without a positive divisor vanishes.
    """
    upper = with_series(metric_select(samples, part)).select("series", "ts_ms", F.col("value").alias("upper"))
    lower = (
        with_series(metric_select(samples, whole))
        .where(F.col("value") > 0)
        .select("series", "ts_ms", F.col("value").alias("lower"))
    )
    return upper.join(lower, ["series", "ts_ms"]).select(
        "series", "ts_ms", (F.col("upper") / F.col("lower") * F.lit(float(scale))).alias("value")
    )


def metric_stickiness(samples: DataFrame) -> DataFrame:
    return metric_ratio(samples, "business_users_dau", "business_users_mau", 100.0)


REDUCERS = {
    "lastNotNull": lambda: F.max_by("value", F.when(F.col("value").isNotNull(), F.col("ts_ms"))),
    "max": lambda: F.max("value"),
    "sum": lambda: F.sum("value"),
    "mean": lambda: F.avg("value"),
}


def metric_reduce(samples: DataFrame, name: str, calcs: Sequence[str] = tuple(REDUCERS)) -> DataFrame:
    """(series, <calc>...): each series of a metric reduced over its samples."""
    return (
        with_series(metric_select(samples, name))
        .groupBy("series")
        .agg(*[REDUCERS[calc]().alias(calc) for calc in calcs])
    )


def metric_stack(samples: DataFrame, name: str) -> DataFrame:
    """(ts_ms, series, value, stacked): each series on top of those before it."""
    below = W.partitionBy("ts_ms").orderBy("series").rowsBetween(W.unboundedPreceding, W.currentRow)
    return with_series(metric_select(samples, name)).select(
        "ts_ms", "series", "value", F.sum("value").over(below).alias("stacked")
    )
