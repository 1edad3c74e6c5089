"""Queries on user behavior over time (flows, cohorts, sessions, sketches, streams) and their SQL."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import catalogue, cohorts, paths, rolling, sessions, sketches, step_funnel
from tidemark.plans import growth_deltas
from tidemark.registry.oracle import ORACLE, VIEWS, with_views
from tidemark.registry.queries import Tables, on_tables
from tidemark.session import scratch_path
from tidemark.sinks import compact_ingested, read_ingested, store_ingested
from tidemark.sources import testdata
from tidemark.streaming import ingest_stream
from tidemark.streaming.activity import append_stream, streamed_actives, streamed_sessions

FLOW = ["signup", "view", ["click", "error"], "purchase"]
WITHIN = timedelta(days=1)
GAP = timedelta(hours=2)
LATE = timedelta(days=40)  # the files of the stream hold the whole history in any order
AS_OF = date(2024, 1, 25)
DAY_ONE = date(2024, 1, 1)

# Flows


@on_tables("step_progress")
def _step_progress(t: Tables) -> DataFrame:
    """First time of each step that a user reached."""
    reached = step_funnel.step_progress(t.events, FLOW, WITHIN)
    return reached.select("user_id", F.posexplode("reached_at").alias("step_no", "reached_at")).where("reached_at IS NOT NULL")


@on_tables("ordered_funnel")
def _ordered_funnel(t: Tables) -> DataFrame:
    return step_funnel.ordered_funnel(step_funnel.step_progress(t.events, FLOW, WITHIN), FLOW)


@on_tables("ordered_funnel_by_platform")
def _ordered_funnel_by_platform(t: Tables) -> DataFrame:
    """With a small bound on the rows of a fold, so that most users take the way of large ones."""
    reached = step_funnel.step_progress(t.events, FLOW, WITHIN, by=["platform"], part_rows=10)
    return step_funnel.ordered_funnel(reached, FLOW, by=["platform"])


def _flow_views(name: str, keys: str) -> None:
    """Per step the times that reach it: of the step before every earlier time is tried."""
    VIEWS[f"{name}_0"] = f"SELECT DISTINCT {keys}, created_at AS hit FROM s_events WHERE event_name = 'signup' AND user_id IS NOT NULL AND created_at IS NOT NULL"
    same = " AND ".join(f"p.{key} IS NOT DISTINCT FROM e.{key}" for key in keys.split(", "))
    for i, names in enumerate(("'view'", "'click', 'error'", "'purchase'"), 1):
        VIEWS[f"{name}_{i}"] = f"""SELECT DISTINCT {keys}, created_at AS hit FROM s_events e WHERE event_name IN ({names})
  AND EXISTS (SELECT 1 FROM {name}_{i - 1} p WHERE {same} AND p.hit < e.created_at AND epoch_us(e.created_at) - epoch_us(p.hit) <= 86400000000)"""
    VIEWS[f"{name}_reached"] = " UNION ALL ".join(f"SELECT {keys}, {i} AS step_no, min(hit) AS reached_at FROM {name}_{i} GROUP BY ALL" for i in range(4))


_flow_views("flow", "user_id")
_flow_views("pflow", "user_id, platform")


def _funnel_sql(name: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return with_views(f"""
SELECT {lead}step_order, step_name, users_count, before - users_count AS step_dropoff_users_count,
  CASE WHEN before > 0 THEN round(users_count / before, 4) ELSE 0 END AS step_conversion_rate,
  CASE WHEN top > 0 THEN round(users_count / top, 4) ELSE 0 END AS overall_conversion_rate, mean_seconds
FROM (SELECT *, coalesce(lag(users_count) OVER w, users_count) AS before, first_value(users_count) OVER w AS top FROM (
  SELECT {"g." + lead if by else ""}n + 1 AS step_order, ['signup', 'view', 'click | error', 'purchase'][n + 1] AS step_name,
    coalesce(users_count, 0) AS users_count, mean_seconds
  FROM {f"(SELECT DISTINCT {by} FROM {name}_reached)" if by else "(SELECT 1 AS one)"} g CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS n)
  LEFT JOIN (SELECT {"a." + lead if by else ""}a.step_no, count(*) AS users_count,
      round(sum(epoch_us(a.reached_at) - epoch_us(b.reached_at)) / count(*) / 1000000) AS mean_seconds
    FROM {name}_reached a LEFT JOIN {name}_reached b
    ON b.user_id = a.user_id AND b.step_no = a.step_no - 1{f" AND b.{by} = a.{by}" if by else ""} GROUP BY ALL) c
  ON c.step_no = n{f" AND c.{by} = g.{by}" if by else ""}) q
WINDOW w AS ({f"PARTITION BY {by} " if by else ""}ORDER BY step_order))""")


ORACLE["step_progress"] = with_views("SELECT user_id, step_no, reached_at FROM flow_reached")
ORACLE["ordered_funnel"] = _funnel_sql("flow")
ORACLE["ordered_funnel_by_platform"] = _funnel_sql("pflow", "platform")

# Cohorts and churn


def _words_in_parts(t: Tables, days: int) -> DataFrame:
    """Bitmaps of each third of the month, merged: as a table kept from load to load."""
    thirds = [t.events.where(f"ceil(day(event_date) / 11) = {i}") for i in (1, 2, 3)]
    return cohorts.merge_words(*(cohorts.activity_words(part, days) for part in thirds))


@on_tables("cohort_retention")
def _cohort_retention(t: Tables) -> DataFrame:
    return cohorts.retention(_words_in_parts(t, 7))


@on_tables("cohort_retention_daily")
def _cohort_retention_daily(t: Tables) -> DataFrame:
    return cohorts.retention(cohorts.activity_words(t.events, 1), 1)


@on_tables("cohort_retention_registered")
def _cohort_retention_registered(t: Tables) -> DataFrame:
    return cohorts.retention(cohorts.activity_words(t.events), registrations=t.users)


@on_tables("growth_accounting")
def _growth_accounting(t: Tables) -> DataFrame:
    return cohorts.growth_accounting(_words_in_parts(t, 1), 1)


@on_tables("churn_features")
def _churn_features(t: Tables) -> DataFrame:
    return cohorts.churn_features(cohorts.activity_words(t.events, 1, DAY_ONE), AS_OF, 1, DAY_ONE)


VIEWS["active_days"] = "SELECT DISTINCT user_id, date_diff('day', DATE '1970-01-05', event_date) AS p FROM s_events WHERE user_id IS NOT NULL AND event_date IS NOT NULL"
VIEWS["active_weeks"] = "SELECT DISTINCT user_id, CAST(floor(p / 7) AS BIGINT) AS p FROM active_days"
VIEWS["seen_days"] = "SELECT user_id, p - date_diff('day', DATE '1970-01-05', DATE '2024-01-25') AS p FROM active_days WHERE p <= date_diff('day', DATE '1970-01-05', DATE '2024-01-25')"


def _retention_sql(active: str, days: int, cohorts_: str | None = None) -> str:
    members = cohorts_ or f"SELECT user_id, min(p) AS c FROM {active} GROUP BY 1"
    return with_views(f"""
SELECT DATE '1970-01-05' + CAST(c * {days} AS INTEGER) AS cohort_start, CAST(k AS INTEGER) AS periods_since, n AS cohort_users,
  coalesce(active, 0) AS active_users, round(coalesce(active, 0) / n, 4) AS retention_rate
FROM (SELECT c, n, unnest(range(0, (SELECT max(p) FROM {active}) - c + 1)) AS k FROM (SELECT c, count(*) AS n FROM ({members}) GROUP BY 1))
LEFT JOIN (SELECT c, p - c AS k, count(*) AS active FROM ({members}) m JOIN {active} a ON a.user_id = m.user_id GROUP BY 1, 2) USING (c, k)""")


ORACLE["cohort_retention"] = _retention_sql("active_weeks", 7)
ORACLE["cohort_retention_daily"] = _retention_sql("active_days", 1)
ORACLE["cohort_retention_registered"] = _retention_sql(
    "active_weeks",
    7,
    "SELECT user_id, CAST(floor(date_diff('day', DATE '1970-01-05', min(registration_date)) / 7) AS BIGINT) AS c FROM s_users WHERE user_id IS NOT NULL GROUP BY 1",
)
ORACLE["growth_accounting"] = with_views("""
SELECT DATE '1970-01-05' + CAST(t AS INTEGER) AS period_start,
  (SELECT count(*) FROM (SELECT min(p) AS f FROM active_days GROUP BY user_id) WHERE f = t) AS new_users,
  (SELECT count(*) FROM active_days a WHERE p = t AND EXISTS (SELECT 1 FROM active_days b WHERE b.user_id = a.user_id AND b.p = t - 1)) AS retained_users,
  (SELECT count(*) FROM active_days a WHERE p = t AND NOT EXISTS (SELECT 1 FROM active_days b WHERE b.user_id = a.user_id AND b.p = t - 1)
    AND EXISTS (SELECT 1 FROM active_days b WHERE b.user_id = a.user_id AND b.p < t)) AS resurrected_users,
  (SELECT count(*) FROM active_days a WHERE p = t - 1 AND NOT EXISTS (SELECT 1 FROM active_days b WHERE b.user_id = a.user_id AND b.p = t)) AS churned_users,
  (SELECT count(*) FROM active_days WHERE p = t) AS active_users
FROM (SELECT unnest(range((SELECT min(p) FROM active_days), (SELECT max(p) FROM active_days) + 1)) AS t)""")
ORACLE["churn_features"] = with_views("""
SELECT user_id, DATE '2024-01-25' + CAST(min(p) AS INTEGER) AS first_active_start, DATE '2024-01-25' + CAST(max(p) AS INTEGER) AS last_active_start,
  CAST(count(*) AS INTEGER) AS active_periods, CAST(-max(p) AS INTEGER) AS idle_periods, CAST(count(*) FILTER (p > -4) AS INTEGER) AS recent_active_periods,
  CAST(coalesce(max(gap), 0) AS INTEGER) AS longest_gap, CAST(count(*) FILTER (island = last_island) AS INTEGER) AS current_streak, -max(p) >= 2 AS is_churned
FROM (SELECT *, last_value(island) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_island
  FROM (SELECT *, p - row_number() OVER (PARTITION BY user_id ORDER BY p) AS island, p - lag(p) OVER (PARTITION BY user_id ORDER BY p) - 1 AS gap FROM seen_days))
GROUP BY user_id""")

# Rolling actives by deltas


@on_tables("growth_by_deltas")
def _growth_by_deltas(t: Tables) -> DataFrame:
    """Three loads, each with events of all dates, the second one run twice, and the layers united before the last."""
    folder = scratch_path(t.spark, "growth")
    for i in (0, 1, 1, 2):
        if i == 2:
            growth_deltas.compact_layers(t.spark, folder)
        growth_deltas.add_activity(t.events.where(f"pmod(hash(event_id), 3) = {i}"), folder)
    return growth_deltas.rolling_counts(t.spark, folder)


ORACLE["growth_by_deltas"] = with_views("""
SELECT d.event_date AS metric_date, count(DISTINCT e.user_id) FILTER (e.event_date = d.event_date) AS dau_count,
  count(DISTINCT e.user_id) FILTER (e.event_date > d.event_date - 7) AS wau_count, count(DISTINCT e.user_id) AS mau_count
FROM (SELECT DISTINCT event_date FROM s_events WHERE event_date IS NOT NULL) d
JOIN s_events e ON e.event_date BETWEEN d.event_date - 29 AND d.event_date GROUP BY 1""")

# Sessions


@on_tables("sessions")
def _sessions(t: Tables) -> DataFrame:
    return sessions.sessionize(t.events, GAP)


@on_tables("session_metrics")
def _session_metrics(t: Tables) -> DataFrame:
    return sessions.session_metrics(sessions.sessionize(t.events, GAP))


VIEWS["session_rows"] = """SELECT user_id, min(created_at) AS session_start, max(created_at) AS session_end,
  (epoch_us(max(created_at)) - epoch_us(min(created_at))) // 1000000 AS duration_seconds, count(*) AS events_count,
  arg_min(event_name, (created_at, event_id)) AS entry_event, arg_max(event_name, (created_at, event_id)) AS exit_event
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY created_at, event_id) AS session_no FROM (
  SELECT *, CASE WHEN epoch_us(created_at) - epoch_us(lag(created_at) OVER (PARTITION BY user_id ORDER BY created_at, event_id)) < 7200000000 THEN 0 ELSE 1 END AS opens
  FROM s_events WHERE user_id IS NOT NULL AND created_at IS NOT NULL)) GROUP BY user_id, session_no"""
ORACLE["sessions"] = with_views("SELECT * FROM session_rows")
ORACLE["session_metrics"] = with_views("""
SELECT CAST(session_start AS DATE) AS metric_date, count(*) AS sessions_count, count(DISTINCT user_id) AS users_count, CAST(sum(events_count) AS BIGINT) AS events_count,
  CAST(sum(duration_seconds) AS BIGINT) AS total_seconds, max(duration_seconds) AS longest_seconds, count(*) FILTER (events_count = 1) AS single_event_sessions
FROM session_rows GROUP BY 1""")

# Streams of the same events


def _streamed(t: Tables, build) -> DataFrame:
    """A stream over files of events in two runs from one checkpoint; the second brings one late event that closes all that is open."""
    folder = scratch_path(t.spark, "event-stream")
    events = t.events.select("user_id", "event_id", "event_name", "created_at")
    closing = t.spark.createDataFrame([("closing", "closing", "closing", datetime(2100, 1, 1))], events.schema)
    for part in (events, closing):
        part.write.mode("append").parquet(f"{folder}/in")
        arriving = t.spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        append_stream(build(arriving), f"{folder}/out", f"{folder}/state", once=True).awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


@on_tables("sessions_stream")
def _sessions_stream(t: Tables) -> DataFrame:
    return _streamed(t, lambda events: streamed_sessions(events, GAP, LATE))


@on_tables("dau_stream")
def _dau_stream(t: Tables) -> DataFrame:
    return _streamed(t, lambda events: streamed_actives(events, LATE))


ORACLE["sessions_stream"] = ORACLE["sessions"]
ORACLE["dau_stream"] = with_views("SELECT event_date AS metric_date, count(DISTINCT user_id) AS dau_count FROM s_events WHERE user_id IS NOT NULL GROUP BY 1")

# Paths


@on_tables("event_paths")
def _event_paths(t: Tables) -> DataFrame:
    return paths.event_paths(t.events, 3)


@on_tables("event_paths_split")
def _event_paths_split(t: Tables) -> DataFrame:
    """All events of a platform as one sequence, in parts of a few rows: the most frequent paths of four events."""
    return paths.top_paths(paths.event_paths(t.events, 4, ["platform"], part_rows=50), 100)


@on_tables("event_transitions")
def _event_transitions(t: Tables) -> DataFrame:
    return paths.event_transitions(t.events)


def _paths_sql(keys: str, length: int, rest: str = "") -> str:
    leads = ", ".join(["event_name", *(f"lead(event_name, {i}) OVER w" for i in range(1, length))])
    return with_views(f"""
SELECT array_to_string(path, ' > ') AS path, count(*) AS occurrences, count(DISTINCT key) AS sessions_count
FROM (SELECT ({keys},) AS key, [{leads}] AS path, lead(1, {length - 1}) OVER w AS whole FROM s_events WHERE created_at IS NOT NULL
  WINDOW w AS (PARTITION BY {keys} ORDER BY created_at, event_id)) WHERE whole = 1 GROUP BY 1 {rest}""")


ORACLE["event_paths"] = _paths_sql("user_id, session_id", 3)
ORACLE["event_paths_split"] = _paths_sql("platform", 4, "ORDER BY occurrences DESC, path LIMIT 100")
ORACLE["event_transitions"] = with_views("""
SELECT from_event, to_event, count(*) AS transitions_count, round(count(*) / sum(count(*)) OVER (PARTITION BY from_event), 4) AS transition_share
FROM (SELECT event_name AS from_event, lead(event_name) OVER w AS to_event, lead(1) OVER w AS whole FROM s_events WHERE created_at IS NOT NULL
  WINDOW w AS (PARTITION BY user_id, session_id ORDER BY created_at, event_id)) WHERE whole = 1 GROUP BY 1, 2""")

# Properties


@on_tables("property_catalogue")
def _property_catalogue(t: Tables) -> DataFrame:
    """Properties of the events; some are given another type, a null, a nested value, or are no JSON."""
    number = F.col("event_id").cast("bigint")
    key = F.get_json_object("properties_json", "$.k")
    changed = (
        F.when(number % 10 == 0, F.concat(F.lit('{"k": "'), key, F.lit('", "more": null}')))
        .when((number % 15 == 0) & (F.col("event_name") != "view"), F.concat(F.lit('{"k": '), key, F.lit('.5, "more": [1, {"x": true}]}')))
        .when(number % 21 == 0, F.concat(F.lit('{"deep": {"k": '), key, F.lit('}, "flag": true}')))
        .when(number % 33 == 0, "{broken")
        .otherwise(F.col("properties_json"))
    )
    return catalogue.property_catalogue(t.events.withColumn("properties_json", changed))


ORACLE["property_catalogue"] = with_views("""
SELECT event_name, property, CAST(sum(n) AS BIGINT) AS events_count, string_agg(kind || ':' || n, ',' ORDER BY kind) AS types,
  count(DISTINCT CASE WHEN kind IN ('integer', 'decimal') THEN 'number' ELSE kind END) FILTER (kind <> 'null') > 1 AS has_conflict, min(first_seen) AS first_seen_date
FROM (SELECT event_name, property, kind, count(*) AS n, min(event_date) AS first_seen FROM (
  SELECT event_name, event_date, property, CASE json_type(json_extract(j, '$.' || property)) WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'decimal'
    WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' END AS kind
  FROM (SELECT event_name, event_date, j, unnest(json_keys(j)) AS property FROM (
    SELECT event_name, event_date, CASE
      WHEN n % 10 = 0 THEN '{"k": "' || k || '", "more": null}' WHEN n % 15 = 0 AND event_name <> 'view' THEN '{"k": ' || k || '.5, "more": [1, {"x": true}]}'
      WHEN n % 21 = 0 THEN '{"deep": {"k": ' || k || '}, "flag": true}' WHEN n % 33 = 0 THEN '{}' ELSE properties_json END AS j
    FROM (SELECT *, CAST(event_id AS BIGINT) AS n, regexp_extract(properties_json, '[0-9]+') AS k FROM s_events)))) GROUP BY 1, 2, 3) GROUP BY 1, 2""")

# Posts stored more than once


@on_tables("ingest_two_loads")
def _ingest_two_loads(t: Tables) -> DataFrame:
    """Posts stored by two loads and a stream into one folder, a load run twice, posts repeated in the stream, and the first two days compacted."""
    folder = scratch_path(t.spark, "two-loads")
    t.spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    posts = testdata.envelopes(t.spark, t.sf_dir)
    third = "pmod(hash(batch_id, endpoint), 3)"
    for i in (0, 1, 1):
        store_ingested(posts.where(f"{third} = {i}"), f"{folder}/events", f"{folder}/bad", writer=f"load-{i}", policy="lenient")
    for copy in (0, 1):
        posts.where(f"{third} = 2").write.parquet(f"{folder}/in/copy={copy}")
    arriving = t.spark.readStream.schema(posts.schema).parquet(f"{folder}/in/*")
    ingest_stream(
        arriving, f"{folder}/events", f"{folder}/bad", f"{folder}/state", policy="lenient", once=True, repeats_within=LATE
    ).awaitTermination()
    first = read_ingested(t.spark, f"{folder}/events").agg(F.min("arrival_date")).first()[0]
    for day in (first, first + timedelta(days=1)):
        compact_ingested(t.spark, f"{folder}/events", day)
    return read_ingested(t.spark, f"{folder}/events").drop("arrival_date")


ORACLE["ingest_two_loads"] = ORACLE["ingest_stream"]

# Distinct counts by sketches


@on_tables("rolling_actives_sketched")
def _rolling_actives_sketched(t: Tables) -> DataFrame:
    """Exact users of the last 1, 7 and 30 days per platform, and whether the merged sketches come within 5 standard errors."""
    halves = [t.events.where(f"pmod(hash(event_id), 2) = {i}") for i in (0, 1)]
    stored = sketches.merge_sketches(*(sketches.actives_sketches(half) for half in halves))
    folder = scratch_path(t.spark, "sketches")
    stored.write.parquet(folder)
    stored = t.spark.read.schema(stored.schema).parquet(folder)
    exact = rolling.rolling_users(t.events, (1, 7, 30))
    bound = 5 * sketches.standard_error()
    near = F.abs(F.col("active_users") - F.col("users")) <= bound * F.col("users")
    rows = sketches.rolling_actives(stored).join(exact, ["metric_date", "platform", "days"], "left").withColumn("users", F.coalesce("users", F.lit(0).cast("long")))
    return rows.select("metric_date", "platform", "days", "users", near.alias("near"))


ORACLE["rolling_actives_sketched"] = with_views("""
SELECT d.metric_date, d.platform, CAST(n AS INTEGER) AS days, count(DISTINCT e.user_id) AS users, TRUE AS near
FROM (SELECT DISTINCT event_date AS metric_date, platform FROM s_events WHERE event_date IS NOT NULL) d CROSS JOIN (SELECT unnest([1, 7, 30]) AS n)
JOIN s_events e ON e.platform = d.platform AND e.event_date BETWEEN d.metric_date - CAST(n - 1 AS INTEGER) AND d.metric_date GROUP BY 1, 2, 3""")
