"""The daily run: raw tables -> models -> checks -> samples and report data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.activity import activity_rollup
from tidemark.operators.quality import counted_columns, dq_report, raise_on_failures
from tidemark.operators.staging import same_key_derivations, stg_events, stg_transactions, stg_users
from tidemark.plans.kpis import dashboard_json
from tidemark.plans.metrics import metric_samples, metrics_exposition
from tidemark.plans.models import (
    int_user_journey,
    mart_event_funnel,
    mart_platform_split,
    mart_revenue,
    mart_user_growth,
)
from tidemark.session import require_utc
from tidemark.sinks import materialize_mart, read_published, release_all, stage_all, stage_mart, write_dashboard_json, write_text
from tidemark.sinks.tables import Staged
from tidemark.sources import read_marts


@dataclass(frozen=True)
class DailyResult:
    tables: Mapping[str, DataFrame]
    report: DataFrame
    metrics_path: str
    dashboard_path: str


def build_models(
    users: DataFrame, events: DataFrame, transactions: DataFrame
) -> dict[str, DataFrame]:
    """All models from staged tables; ``events`` may be the rollup of the staged events."""
    return {
        "int_user_journey": int_user_journey(users, events, transactions),
        "mart_user_growth": mart_user_growth(users, events),
        "mart_event_funnel": mart_event_funnel(events),
        "mart_revenue": mart_revenue(transactions),
        "mart_platform_split": mart_platform_split(users, events, transactions),
    }


def stage_activity(events: DataFrame, path: str, since: str | date | None = None) -> Staged:
    """A new version of the rollup of staged events, one folder per date, for a release.

    With ``since`` only events from that date on (and undated ones) are read. Their dates
    and the undated rows are replaced as a whole, so a date that has lost its events goes;
    earlier dates are taken over from the published rollup. Give the earliest date that
    got, lost or changed events since the last run that was released.
    """
    if since is None:
        return stage_mart(activity_rollup(events), "event_activity", path, "event_date")
    first = F.lit(str(since)).cast("date")
    happened = F.col("created_at")  # of this column the scan keeps statistics
    fresh = activity_rollup(events.where((happened >= first.cast("timestamp_ntz")) | happened.isNull()))
    kept = read_published(events.sparkSession, path)
    if kept is not None:
        fresh = fresh.unionByName(kept.where(F.col("event_date") < first).select(fresh.columns))
    return stage_mart(fresh, "event_activity", path, "event_date")


def refresh_activity(events: DataFrame, path: str, since: str | date | None = None) -> DataFrame:
    """Publishes the rollup by itself, as ``stage_activity`` writes it, and returns all of it."""
    return stage_activity(events, path, since).release()


def samples_run(spark: SparkSession, published: str, out: str, ts_ms: int, one_file: bool = False) -> str:
    """Metric text of the tables that an earlier run published; tables that are missing give no samples."""
    marts = read_marts(spark, require_all=False, path=published)
    return write_text(metrics_exposition(_samples(marts, ts_ms)), out, one_file)


def report_run(spark: SparkSession, published: str, out: str) -> str:
    """Report JSON of the tables that an earlier run published; all must be there."""
    return write_dashboard_json(_report(read_marts(spark, require_all=True, path=published)), out)


def _samples(marts: Mapping[str, DataFrame], ts_ms: int) -> DataFrame:
    return metric_samples(*(marts.get(f"mart_{n}") for n in ("user_growth", "revenue", "event_funnel", "platform_split")), ts_ms=ts_ms)


def _report(marts: Mapping[str, DataFrame]) -> DataFrame:
    return dashboard_json(*(marts[f"mart_{n}"] for n in ("user_growth", "event_funnel", "revenue", "platform_split")))


def daily_run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str,
    ts_ms: int,
    check: bool = True,
    since: str | date | None = None,
) -> DailyResult:
    """Builds and publishes everything below ``out`` (a folder all executors share).

    ``raw`` holds ``users``, ``analytics_events`` and ``transactions``. All models
    are built from one rollup of the events, so the wide event table is read once
    for them (from ``since`` on, if given) and once more, ids, names and times
    only, for the checks on it. Written tables hand one stage to the next: a lost executor
    costs at most the stage it worked on. The checks look at the new versions before they
    are released, the rollup and all models by one mark: after a failed check, or a crash
    at any place, readers and the next ``since`` have the tables of the run before, and no
    samples and report data are written.
    """
    require_utc(spark)
    staged = {
        "stg_users": stg_users(raw["users"]),
        "stg_events": stg_events(raw["analytics_events"]),
        "stg_transactions": stg_transactions(raw["transactions"]),
    }
    activity = stage_activity(staged["stg_events"], f"{out}/event_activity", since)
    models = build_models(staged["stg_users"], activity.rows, staged["stg_transactions"])
    written = stage_all(models, out, counted_columns())

    sources = {f"raw_{name}": df for name, df in raw.items()}
    rows = {name: table.rows for name, table in written.items()}
    nulls = {name: table.nulls for name, table in written.items()}
    checks = dq_report(sources | staged | rows, derived=same_key_derivations(), nulls=nulls)
    report = materialize_mart(checks, "dq_report", f"{out}/dq_report")
    if check:
        raise_on_failures(report)

    published = release_all({"event_activity": activity, **written}, out)
    published.pop("event_activity")
    metrics_path = write_text(metrics_exposition(_samples(published, ts_ms)), f"{out}/metrics")
    dashboard_path = write_dashboard_json(_report(published), f"{out}/dashboard")
    return DailyResult(published, report, metrics_path, dashboard_path)
