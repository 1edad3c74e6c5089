"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import label_text, threshold_band
from tidemark.functions.properties import merge_properties, purchase_items, typed_event_properties
from tidemark.operators import accounts, activity, calendar, quality, ranking, rolling, staging
from tidemark.operators import ingest
from tidemark.plans import kpis, metric_queries, metrics, models, summary
from tidemark.plans.daily import build_models, daily_run, samples_run
from tidemark.plans.extract import extract
from tidemark.schemas import backend_events_as_raw
from tidemark.session import scratch_path
from tidemark.sinks import materialize_mart, register_raw, stage_all, write_snapshots, write_text
from tidemark.sinks.tables import Staged
from tidemark.sources import JdbcSource, ga4_normalize, read_parquet_raw, testdata, union_event_sources
from tidemark.streaming import ingest_stream, read_ingested

TS_MS = 1_706_659_200_000  # 2024-01-31 00:00 UTC
DAY_MS = 86_400_000
AS_OF = "2024-01-30 12:00:00"
SUMMARY_DAYS = 10

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


class Tables:
    """Raw, staged and published tables of one scale; nothing runs until asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_users(self) -> DataFrame:
        return testdata.raw_users(self.spark, self.sf_dir)

    @cached_property
    def raw_events(self) -> DataFrame:
        return testdata.raw_analytics_events(self.spark, self.sf_dir)

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return testdata.raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def users(self) -> DataFrame:
        return staging.stg_users(self.raw_users)

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_events(self.raw_events)

    @cached_property
    def transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw_transactions)

    @cached_property
    def activity(self) -> DataFrame:
        """The rollup of the events, written once; what is built on it reads the wide events no more."""
        path = scratch_path(self.spark, "activity")
        activity.activity_rollup(self.events).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def staged_models(self) -> dict[str, Staged]:
        """The models, each written once from the rollup, with the NULLs that the checks ask for counted on the way."""
        models_ = build_models(self.users, self.activity, self.transactions)
        return stage_all(models_, scratch_path(self.spark, "models"), quality.counted_columns())

    @property
    def stored(self) -> dict[str, DataFrame]:
        return {name: table.rows for name, table in self.staged_models.items()}

    @cached_property
    def journey(self) -> DataFrame:
        return models.int_user_journey(self.users, self.events, self.transactions)

    @cached_property
    def growth(self) -> DataFrame:
        return models.mart_user_growth(self.users, self.events)

    @cached_property
    def funnel(self) -> DataFrame:
        return models.mart_event_funnel(self.events)

    @cached_property
    def revenue(self) -> DataFrame:
        return models.mart_revenue(self.transactions)

    @cached_property
    def platform(self) -> DataFrame:
        return models.mart_platform_split(self.users, self.events, self.transactions)


def on_tables(name: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Registers a query that needs only the tables of its scale."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        return build

    return add


def _simple(**builds: Callable[[Tables], DataFrame]) -> None:
    for name, build in builds.items():
        on_tables(name)(build)


# Raw tables, sources and sinks

_simple(
    raw_users=lambda t: t.raw_users,
    raw_analytics_events=lambda t: t.raw_events,
    raw_transactions=lambda t: t.raw_transactions,
    raw_order_transactions=lambda t: testdata.raw_order_transactions(t.spark, t.sf_dir),
)


@query("read_parquet_raw")
def _read_parquet_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet_raw(spark, f"{sf_dir}/events.parquet")


@on_tables("write_snapshot")
def _write_snapshot(t: Tables) -> DataFrame:
    written = write_snapshots({"users": lambda: t.raw_users}, scratch_path(t.spark, "snapshot"))
    return read_parquet_raw(t.spark, written["users"], "users")


@on_tables("register_raw")
def _register_raw(t: Tables) -> DataFrame:
    loads = {"users": lambda: t.raw_users, "analytics_events": lambda: t.raw_events, "transactions": lambda: t.raw_transactions}
    names = register_raw(t.spark, write_snapshots(loads, scratch_path(t.spark, "register")))
    counts = [t.spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.union, counts)


@on_tables("materialize_mart")
def _materialize_mart(t: Tables) -> DataFrame:
    return materialize_mart(t.revenue, "mart_revenue", scratch_path(t.spark, "mart"), "metric_date").select(t.revenue.columns)


@query("ga4_normalize")
def _ga4_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ga4_normalize(testdata.ga4_report(spark, sf_dir), "report_order")


@on_tables("union_event_sources")
def _union_event_sources(t: Tables) -> DataFrame:
    report = ga4_normalize(testdata.ga4_report(t.spark, t.sf_dir), "report_order")
    return activity.platform_events(staging.stg_events(union_event_sources(t.raw_events, report)))


# Staging and filters

_simple(
    stg_users=lambda t: t.users,
    stg_events=lambda t: t.events,
    stg_transactions=lambda t: t.transactions,
    events_filtered=lambda t: summary.events_filtered(
        t.events,
        name="click",
        category="navigation",
        platform="ANDROID",
        start="2024-01-05 00:00:00",
        end="2024-01-20 00:00:00",
        time="created_at",
    ),
)

# Aggregates

_simple(
    activity_rollup=lambda t: activity.activity_rollup(t.events),
    user_events_summary=lambda t: activity.user_events_summary(t.events),
    user_transactions_summary=lambda t: accounts.user_transactions_summary(t.transactions),
    daily_new_users=lambda t: accounts.daily_new_users(t.users),
    dau=lambda t: activity.dau(t.events),
    user_days=lambda t: activity.user_days(t.events),
    wau_mau=lambda t: rolling.wau_mau(calendar.calendar_dates(t.users, t.events), activity.user_days(t.events)),
    event_totals=lambda t: activity.event_totals(t.events),
    daily_revenue=lambda t: accounts.daily_revenue(t.transactions),
    platform_events=lambda t: activity.platform_events(t.events),
    platform_registrations=lambda t: accounts.platform_registrations(t.users),
    platform_transactions=lambda t: accounts.platform_transactions(t.transactions, t.users),
    calendar_dates=lambda t: calendar.calendar_dates(t.users, t.events),
    calendar_platforms=lambda t: calendar.calendar_platforms(
        activity.platform_events(t.events),
        accounts.platform_registrations(t.users),
        accounts.platform_transactions(t.transactions, t.users),
    ),
)

# Models

_simple(
    int_user_journey=lambda t: t.journey,
    mart_user_growth=lambda t: t.growth,
    mart_event_funnel=lambda t: t.funnel,
    mart_revenue=lambda t: t.revenue,
    mart_revenue_orders=lambda t: models.mart_revenue(
        staging.stg_transactions(testdata.raw_order_transactions(t.spark, t.sf_dir))
    ),
    mart_platform_split=lambda t: t.platform,
    mart_platform_split_null_safe=lambda t: models.mart_platform_split(
        t.users, t.events, t.transactions, null_safe=True
    ),
    mart_user_growth_from_rollup=lambda t: models.mart_user_growth(t.users, activity.activity_rollup(t.events)),
    mart_event_funnel_from_rollup=lambda t: models.mart_event_funnel(activity.activity_rollup(t.events)),
)

# Summaries

_simple(
    event_metrics_summary=lambda t: summary.summary_report(t.events, AS_OF, SUMMARY_DAYS, time="created_at"),
    event_metrics_summary_raw=lambda t: summary.summary_report(
        t.raw_events, AS_OF, SUMMARY_DAYS, "unknown", time="created_at"
    ),
    event_metrics_totals=lambda t: summary.event_metrics_summary(t.events, AS_OF, SUMMARY_DAYS, time="created_at")["totals"],
    event_metrics_platforms=lambda t: summary.event_metrics_summary(
        t.raw_events, AS_OF, SUMMARY_DAYS, time="created_at"
    )["platforms"],
    top_events=lambda t: summary.top_events(t.events),
)

# Data quality


@on_tables("dq_not_null")
def _dq_not_null(t: Tables) -> DataFrame:
    return quality.dq_not_null(t.raw_transactions, ["id", "user_id", "currency", "status", "payment_method", "amount"])


_simple(dq_unique=lambda t: quality.dq_unique(t.transactions, "user_id"))


@on_tables("dq_report")
def _dq_report(t: Tables) -> DataFrame:
    return quality.dq_report(
        {
            "raw_users": t.raw_users,
            "raw_analytics_events": t.raw_events,
            "raw_transactions": t.raw_transactions,
            "stg_users": t.users,
            "stg_events": t.events,
            "stg_transactions": t.transactions,
            **t.stored,
        },
        derived=staging.same_key_derivations(),
        nulls={name: table.nulls for name, table in t.staged_models.items()},
    )


# Latest rows, samples, exposition

_simple(
    latest_growth=lambda t: ranking.latest_row(t.growth),
    latest_slice=lambda t: ranking.latest_slice(t.revenue),
    first_last_step=lambda t: ranking.first_last_step(t.funnel),
)


def sample_rows(samples: DataFrame) -> DataFrame:
    """Samples with labels as text and the order spelled out."""
    return samples.select("metric", label_text(F.col("labels")).alias("labels"), "value", "ts_ms", "ord.*")


def all_samples(t: Tables) -> DataFrame:
    """Samples from tables that share one rollup; each table is computed once, for its latest rows."""
    users, events, paid = t.users, t.activity, t.transactions
    return metrics.metric_samples(
        models.mart_user_growth(users, events),
        t.revenue,
        models.mart_event_funnel(events),
        models.mart_platform_split(users, events, paid),
        ts_ms=TS_MS,
    )


_simple(
    metrics_user_growth=lambda t: sample_rows(metrics.metrics_user_growth(t.growth, TS_MS)),
    metrics_revenue=lambda t: sample_rows(metrics.metrics_revenue(t.revenue, TS_MS)),
    metrics_funnel=lambda t: sample_rows(metrics.metrics_funnel(t.funnel, TS_MS)),
    metrics_platform=lambda t: sample_rows(metrics.metrics_platform(t.platform, TS_MS)),
    metric_samples=lambda t: sample_rows(all_samples(t)),
    metrics_exposition=lambda t: metrics.metrics_exposition(all_samples(t)).select("ord.*", "line_in_sample", "line"),
)


@on_tables("write_text")
def _write_text(t: Tables) -> DataFrame:
    lines = metrics.metrics_exposition(metrics.metrics_funnel(t.funnel, TS_MS))
    return t.spark.read.text(write_text(lines, scratch_path(t.spark, "text"))).select(F.col("value").alias("line"))


# Queries on samples


def growth_history(t: Tables) -> DataFrame:
    return metrics.metrics_user_growth(t.growth, history=True)


def revenue_history(t: Tables) -> DataFrame:
    return metrics.metrics_revenue(t.revenue, history=True)


def platform_history(t: Tables) -> DataFrame:
    return metrics.metrics_platform(t.platform, history=True)


def rounded(vector: DataFrame, *names: str) -> DataFrame:
    """Sums and means of doubles depend on the order of adding in the last digits."""
    for name in names or ("value",):
        vector = vector.withColumn(name, F.round(name, 6))
    return vector


def without_labels(vector: DataFrame) -> DataFrame:
    return vector.drop("labels")


_simple(
    metric_instant=lambda t: without_labels(
        metric_queries.metric_instant(platform_history(t), "business_platform_active_users")
    ),
    metric_instant_matched=lambda t: without_labels(
        metric_queries.metric_instant(
            platform_history(t), "business_platform_events_total", {"platform": "ios"}, TS_MS - 10 * DAY_MS
        )
    ),
    metric_sum=lambda t: rounded(
        metric_queries.metric_agg(revenue_history(t), "business_revenue_cumulative_total", "sum")
    ),
    metric_avg_positive=lambda t: rounded(
        metric_queries.metric_agg(
            revenue_history(t), "business_revenue_average_order_value", "avg", where=F.col("value") > 0
        )
    ),
    metric_max=lambda t: metric_queries.metric_agg(
        metrics.metrics_funnel(t.funnel, TS_MS), "business_funnel_step_unique_users", "max", match={"step_order": "1"}
    ),
    metric_sum_by=lambda t: rounded(
        metric_queries.metric_agg(
            revenue_history(t), "business_revenue_cumulative_total", "sum", by=["payment_method"]
        )
    ),
    metric_scale=lambda t: without_labels(
        metric_queries.metric_scale(
            metric_queries.metric_instant(
                metrics.metrics_funnel(t.funnel, TS_MS), "business_funnel_overall_conversion_ratio"
            ),
            100,
        )
    ),
    metric_stickiness=lambda t: metric_queries.metric_stickiness(growth_history(t)),
    metric_range=lambda t: metric_queries.metric_range(
        revenue_history(t),
        "business_revenue_daily_amount",
        TS_MS - 20 * DAY_MS,
        TS_MS,
        "{{payment_method}} ({{currency}})",
    ),
    metric_reduce=lambda t: rounded(
        metric_queries.metric_reduce(platform_history(t), "business_platform_revenue_total"),
        "lastNotNull", "max", "sum", "mean",
    ).withColumnRenamed("lastNotNull", "last_not_null"),
    metric_stack=lambda t: rounded(
        metric_queries.metric_stack(revenue_history(t), "business_revenue_daily_amount"), "stacked"
    ),
    bottomk=lambda t: without_labels(
        metric_queries.bottomk(platform_history(t), "business_platform_active_users", 1)
    ),
    bottomk_funnel=lambda t: without_labels(
        metric_queries.metric_scale(
            metric_queries.bottomk(
                metrics.metrics_funnel(t.funnel, TS_MS), "business_funnel_overall_conversion_ratio", 1
            ),
            100,
        )
    ),
)

# Report numbers

_simple(
    kpi_latest_growth=lambda t: kpis.kpi_latest_growth(t.growth),
    kpi_funnel=lambda t: kpis.kpi_funnel(t.funnel),
    kpi_revenue=lambda t: kpis.kpi_revenue(t.revenue),
    kpi_revenue_orders=lambda t: kpis.kpi_revenue(
        models.mart_revenue(staging.stg_transactions(testdata.raw_order_transactions(t.spark, t.sf_dir)))
    ),
    dashboard_kpis=lambda t: kpis.dashboard_kpis(
        models.mart_user_growth(t.users, t.activity), models.mart_event_funnel(t.activity), t.revenue
    ),
    growth_series=lambda t: kpis.growth_series(t.growth),
    funnel_series=lambda t: kpis.funnel_series(t.funnel),
    revenue_series=lambda t: kpis.revenue_series(t.revenue),
    platform_series=lambda t: kpis.platform_series(t.platform),
    kpi_platform_totals=lambda t: kpis.kpi_platform_totals(t.platform),
    revenue_by_date=lambda t: kpis.revenue_by_date(t.revenue),
    platform_share_users=lambda t: kpis.platform_share(kpis.kpi_platform_totals(t.platform), "users"),
    platform_share_events=lambda t: kpis.platform_share(kpis.kpi_platform_totals(t.platform), "events"),
    platform_share_revenue=lambda t: kpis.platform_share(kpis.kpi_platform_totals(t.platform), "revenue"),
    funnel_table_format=lambda t: kpis.funnel_table_format(t.funnel),
    threshold_band=lambda t: t.growth.select(
        "metric_date",
        threshold_band(
            kpis.percent(F.col("dau_to_mau_stickiness_ratio")), kpis.STICKINESS_CUTS, kpis.BAND_NAMES
        ).alias("stickiness_band"),
    ),
)

def json_fields(lines: DataFrame) -> DataFrame:
    """Every field of every JSON line: a number, a text, or neither for null."""
    fields = F.explode(F.from_json("json", "map<string,string>"))
    number = F.col("value").try_cast("double")
    split = lines.select("section", "sort_key", fields.alias("field", "value"))
    return split.select("section", "sort_key", "field", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))


@on_tables("dashboard_json")
def _dashboard_json(t: Tables) -> DataFrame:
    """The JSON lines of the stored tables, read back field by field."""
    names = ("mart_user_growth", "mart_event_funnel", "mart_revenue", "mart_platform_split")
    return json_fields(kpis.dashboard_json(*(t.stored[n] for n in names)))


# The daily run, read back from what it published


def _daily(t: Tables):
    raw = {"users": t.raw_users, "analytics_events": t.raw_events, "transactions": t.raw_transactions}
    return daily_run(t.spark, raw, scratch_path(t.spark, "daily"), ts_ms=TS_MS, check=False)


@on_tables("daily_report")
def _daily_report(t: Tables) -> DataFrame:
    return _daily(t).report


@on_tables("daily_samples")
def _daily_samples(t: Tables) -> DataFrame:
    """The pushed text of a run, and that of the samples-only job on its tables (both lines once)."""
    folder = scratch_path(t.spark, "daily")
    raw = {"users": t.raw_users, "analytics_events": t.raw_events, "transactions": t.raw_transactions}
    pushed = daily_run(t.spark, raw, folder, ts_ms=TS_MS, check=False).metrics_path
    again = samples_run(t.spark, folder, f"{folder}/samples_again", TS_MS)
    lines = [t.spark.read.text(path).select(F.col("value").alias("line")) for path in (pushed, again)]
    return lines[0].union(lines[1]).groupBy("line").agg((F.count(F.lit(1)) / 2).cast("int").alias("times"))


@on_tables("daily_dashboard")
def _daily_dashboard(t: Tables) -> DataFrame:
    """The report lines of a run, read back: every field of every line, and how many lines of a section have it."""
    lines = t.spark.read.text(_daily(t).dashboard_path).select("section", F.lit("").alias("sort_key"), F.col("value").alias("json"))
    return json_fields(lines).groupBy("section", "field", "number", "text").agg(F.count(F.lit(1)).alias("n_lines"))


@on_tables("extract_tables")
def _extract_tables(t: Tables) -> DataFrame:
    """The tables that an extraction chooses of those a source has, in order, as they were copied and registered."""
    loads = {"transactions": lambda: t.raw_transactions, "audit": lambda: t.raw_users, "users": lambda: t.raw_users, "analytics_events": lambda: t.raw_events}
    source = JdbcSource("postgresql", "nowhere", "d", "u", "p")
    folder = scratch_path(t.spark, "extract")
    written = extract(t.spark, source, folder, available=lambda *_: list(loads), read=lambda _, __, name: loads[name]())
    counts = [
        t.spark.table(f"raw_{name}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(i).alias("position"), F.lit(name).alias("table_name"), "row_count")
        for i, name in enumerate(written)
    ]
    return reduce(DataFrame.union, counts)


@on_tables("mart_orderings")
def _mart_orderings(t: Tables) -> DataFrame:
    """The rows of the published tables by their place in reading order."""
    keys = {
        "mart_user_growth": ["metric_date"],
        "mart_event_funnel": ["event_name"],
        "mart_revenue": ["metric_date", "currency", "payment_method"],
        "mart_platform_split": ["metric_date", "platform"],
    }
    placed = []
    for name, columns in keys.items():
        rows = models.in_reading_order(name, t.stored[name]).withColumn("place", F.monotonically_increasing_id())
        text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns))
        placed.append(ranking.dense_index(rows.select("place", text.alias("key")), "place", "position").select(F.lit(name).alias("mart"), "position", "key"))
    return reduce(DataFrame.union, placed)


# Posted events


def _envelopes(t: Tables) -> DataFrame:
    t.spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return testdata.envelopes(t.spark, t.sf_dir)


def rejected_rows(rejected: DataFrame) -> DataFrame:
    return rejected.select("batch_id", "endpoint", "pos", F.array_join("errors", ",").alias("errors"))


@on_tables("ingest_parse")
def _ingest_parse(t: Tables) -> DataFrame:
    good, corrupt = ingest.ingest_parse(_envelopes(t))
    return good.select("batch_id", "endpoint", F.lit(True).alias("readable")).union(
        corrupt.select("batch_id", "endpoint", F.lit(False))
    )


@on_tables("ingest_explode_batch")
def _ingest_explode_batch(t: Tables) -> DataFrame:
    items = ingest.ingest_explode_batch(ingest.parse_body(_envelopes(t)))
    return items.select("batch_id", "endpoint", "pos", F.col("fields.event_name").cast("string").alias("event_name"))


@on_tables("ingest_validate")
def _ingest_validate(t: Tables) -> DataFrame:
    items = ingest.ingest_explode_batch(ingest.parse_body(_envelopes(t)))
    return ingest.ingest_validate(items).select("batch_id", "pos", F.array_join("errors", ",").alias("errors"))


@on_tables("event_id")
def _event_id(t: Tables) -> DataFrame:
    items = ingest.ingest_explode_batch(ingest.parse_body(_envelopes(t)))
    return items.select("batch_id", "pos", ingest.event_id().alias("id"))


_simple(
    ingest_enrich=lambda t: ingest.ingest_enrich(
        ingest.ingest_explode_batch(ingest.parse_body(_envelopes(t))), user_fallback="null"
    ),
    ingest_batch_policy_atomic=lambda t: ingest.ingest_batch_policy(_envelopes(t), "atomic")[0],
    ingest_batch_policy_lenient=lambda t: ingest.ingest_batch_policy(_envelopes(t), "lenient")[0],
    ingest_quarantine_atomic=lambda t: rejected_rows(ingest.ingest_batch_policy(_envelopes(t), "atomic")[1]),
    ingest_quarantine_lenient=lambda t: rejected_rows(ingest.ingest_batch_policy(_envelopes(t), "lenient")[1]),
)


def _streamed(t: Tables) -> str:
    """Posted events and batches as a file stream, handled to the end; the folder with what was stored."""
    folder = scratch_path(t.spark, "stream")
    posts = _envelopes(t)
    posts.write.parquet(f"{folder}/posts")
    arriving = t.spark.readStream.schema(posts.schema).parquet(f"{folder}/posts")
    running = ingest_stream(
        arriving, f"{folder}/events", f"{folder}/quarantine", f"{folder}/checkpoint", policy="lenient", once=True
    )
    running.awaitTermination()
    return folder


@on_tables("ingest_stream")
def _ingest_stream(t: Tables) -> DataFrame:
    return read_ingested(t.spark, f"{_streamed(t)}/events").drop("arrival_date")


@on_tables("ingest_to_growth")
def _ingest_to_growth(t: Tables) -> DataFrame:
    """From stored posts through the staged events to a published table."""
    stored = read_ingested(t.spark, f"{_streamed(t)}/events")
    return models.mart_user_growth(t.users, staging.stg_events(backend_events_as_raw(stored)))


@query("merge_properties")
def _merge_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = F.create_map(F.lit("k"), F.lit("0"), F.lit("kind"), F.col("event_type"))
    own = F.from_json("props", "map<string,string>")
    return testdata.table(spark, sf_dir, "events").select(
        "event_id", label_text(merge_properties(shared, own)).alias("merged")
    )


@query("typed_event_properties")
def _typed_event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_event_properties(testdata.sdk_events(spark, sf_dir))
    return typed.withColumn("items", F.size("items")).withColumnRenamed("items", "item_count")


@query("purchase_items")
def _purchase_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = purchase_items(typed_event_properties(testdata.sdk_events(spark, sf_dir)))
    return items.select("event_id", "item_no", F.col("item")["sku"].alias("sku"), F.col("item")["qty"].alias("qty"))
