"""Declared checks on tables: no NULLs, no repeated values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import Derivation


@dataclass(frozen=True)
class Checks:
    """Columns of one table that must hold no NULL, and those that must be unique."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()


# The declared checks per table.
DECLARED = {
    "raw_users": Checks(["id", "created_at"], ["id"]),
    "raw_analytics_events": Checks(["id", "event_name", "created_at"], ["id"]),
    "raw_transactions": Checks(["id", "amount", "created_at"], ["id"]),
    "stg_users": Checks(["user_id", "registration_date"], ["user_id"]),
    "stg_events": Checks(["event_id", "event_name", "event_date"], ["event_id"]),
    "stg_transactions": Checks(["transaction_id", "amount", "transaction_date"], ["transaction_id"]),
    "int_user_journey": Checks(
        ["user_id", "registered_at", "has_performed_event", "has_converted_paying"], ["user_id"]
    ),
    "mart_user_growth": Checks(["metric_date", "dau_count", "mau_count"], ["metric_date"]),
    "mart_event_funnel": Checks(["funnel_step_order", "event_name", "unique_users_count"], ["funnel_step_order"]),
    "mart_revenue": Checks(["metric_date", "daily_gross_revenue"]),
    "mart_platform_split": Checks(["metric_date", "platform", "active_users_count"]),
}


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures): rows with NULL, for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column", "failures")


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """(value, occurrences) of values that occur more than once; NULL is not tested."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def _results(model: str, prefix: str, checks: Checks, repeated: Mapping[str, str]) -> list[Column]:
    """One struct (model, column, test, failures) per check, from one row of totals."""

    def result(column: str, test: str, total: str) -> Column:
        return F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column"),
            F.lit(test).alias("test"),
            F.coalesce(F.col(total), F.lit(0)).alias("failures"),
        )

    return [result(name, "not_null", f"{prefix}{name}") for name in checks.not_null] + [
        result(column, "unique", total) for column, total in repeated.items()
    ]


def check_written(df: DataFrame, checks: Checks, nulls: Mapping[str, int], model: str = "") -> DataFrame:
    """(model, column, test, failures) of a table whose NULLs were counted as it was written.

    Nothing is read for them; each unique column is read alone and grouped.
    """
    counts = [dq_unique(df, key).agg(F.count(F.lit(1)).alias("repeated")) for key in checks.unique]
    parts = [count.select(F.inline(F.array(*_results(model, "", Checks(), {key: "repeated"})))) for key, count in zip(checks.unique, counts)]
    if checks.not_null:
        rows = [(model, name, "not_null", nulls[name]) for name in checks.not_null]
        parts.append(df.sparkSession.createDataFrame(rows, "model string, column string, test string, failures bigint"))
    return reduce(DataFrame.union, parts)


def check_table(df: DataFrame, checks: Checks, model: str = "") -> DataFrame:
    """(model, column, test, failures) of one table.

    With a unique column the rows are grouped by it, and the same grouping
    counts the NULLs of the other columns: one pass and one shuffle per table.
    """
    nulls = [f"null_{name}" for name in checks.not_null]
    flags = [F.col(name).isNull().alias(f"null_{name}") for name in checks.not_null]
    counts = [F.count_if(F.col(name)).alias(name) for name in nulls]
    keys = list(checks.unique)
    if keys:
        per_key = df.select(F.col(keys[0]).alias("key_value"), *flags).groupBy("key_value")
        totals = per_key.agg(F.count(F.lit(1)).alias("key_rows"), *counts).agg(
            *[F.sum(name).alias(name) for name in nulls], _repeated("key_rows").alias("repeated")
        )
    else:
        totals = df.select(*flags).agg(*counts)
    results = _results(model, "null_", checks, {key: "repeated" for key in keys[:1]})
    report = totals.select(F.inline(F.array(*results)))
    for extra in keys[1:]:
        count = dq_unique(df, extra).agg(F.count(F.lit(1)).alias("repeated"))
        report = report.union(count.select(F.inline(F.array(*_results(model, "", Checks(), {extra: "repeated"})))))
    return report


def _repeated(rows: str) -> Column:
    return F.count_if(F.col("key_value").isNotNull() & (F.col(rows) > 1))


def check_pair(
    raw: DataFrame, derivation: Derivation, raw_checks: Checks, staged_checks: Checks, staged_model: str
) -> DataFrame:
    """The checks of a raw table and of the staged table made from it, in one grouping.

    The staged unique id must be the raw one as text. Grouping by id is the one
    large shuffle of the checks, so the two tables share it.
    """
    kept = derivation.kept
    flags = {f"raw_{name}": F.col(name).isNull() for name in raw_checks.not_null}
    flags |= {f"staged_{name}": kept & derivation.columns[name].isNull() for name in staged_checks.not_null}
    totals = (
        raw.select(
            F.col(raw_checks.unique[0]).alias("key_value"),
            kept.alias("kept"),
            *[flag.alias(name) for name, flag in flags.items()],
        )
        .groupBy("key_value")
        .agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(F.col("kept")).alias("staged_rows"),
            *[F.count_if(F.col(name)).alias(name) for name in flags],
        )
        .agg(
            *[F.sum(name).alias(name) for name in flags],
            _repeated("raw_rows").alias("raw_repeated"),
            _repeated("staged_rows").alias("staged_repeated"),
        )
    )
    results = _results(derivation.raw, "raw_", raw_checks, {raw_checks.unique[0]: "raw_repeated"})
    results += _results(staged_model, "staged_", staged_checks, {staged_checks.unique[0]: "staged_repeated"})
    return totals.select(F.inline(F.array(*results)))


def dq_report(
    tables: Mapping[str, DataFrame],
    declared: Mapping[str, Checks] = DECLARED,
    derived: Mapping[str, Derivation] | None = None,
    nulls: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """(model, column, test, failures) for every declared check of the given tables.

    A staged table named in ``derived`` is checked together with its raw table. ``nulls``
    has, per table, the NULLs of its columns that were counted when it was written.
    """
    nulls = nulls or {}
    unknown = sorted(set(tables) - set(declared))
    if unknown:
        raise ValueError(f"no checks declared for {', '.join(unknown)}")
    pairs = {name: d for name, d in (derived or {}).items() if name in tables and d.raw in tables}
    together = set(pairs) | {d.raw for d in pairs.values()}
    parts = [check_pair(tables[d.raw], d, declared[d.raw], declared[name], name) for name, d in pairs.items()]
    for name, df in tables.items():
        if name in nulls:
            parts.append(check_written(df, declared[name], nulls[name], name))
        elif name not in together:
            parts.append(check_table(df, declared[name], name))
    return reduce(DataFrame.union, parts)


def counted_columns(declared: Mapping[str, Checks] = DECLARED) -> dict[str, Sequence[str]]:
    """Per table the columns whose NULLs its writer should count."""
    return {name: checks.not_null for name, checks in declared.items()}


class QualityError(RuntimeError):
    """At least one declared check failed."""


def raise_on_failures(report: DataFrame) -> None:
    """Stop before publishing if any check failed (the report has one row per check)."""
    failed = report.where(F.col("failures") > 0).orderBy("model", "column", "test").collect()
    if failed:
        lines = [f"{row['model']}.{row['column']} {row['test']}: {row['failures']}" for row in failed]
        raise QualityError("; ".join(lines))
