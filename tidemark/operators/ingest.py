"""Checking and enriching posted events. The same code runs in batch and in a stream.

An envelope row is one request: ``batch_id``, ``endpoint`` (``event`` or
``batch``), ``value`` (body text), ``arrival_ts``, ``auth_user_id``,
``forwarded_for``, ``peer_address``, ``user_agent``. Time, identity and
addresses are columns, so running again gives the same rows.

Everything here is a projection: no shuffle, one pass over the bodies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import event_time
from tidemark.session import require_repeated_keys

# Largest field lengths and largest batch.
FIELD_LENGTHS = {
    "event_name": 255,
    "event_category": 100,
    "user_id": 255,
    "session_id": 255,
    "platform": 50,
    "app_version": 50,
    "os_version": 50,
    "device_model": 100,
}
MAX_BATCH = 500

# Columns of the request that go with each of its events; the body does not.
REQUEST = [
    "batch_id",
    "endpoint",
    "arrival_ts",
    "auth_user_id",
    "forwarded_for",
    "peer_address",
    "user_agent",
]
ENVELOPE_SCHEMA = (
    "batch_id STRING, endpoint STRING, value STRING, arrival_ts TIMESTAMP_NTZ, auth_user_id STRING, "
    "forwarded_for STRING, peer_address STRING, user_agent STRING"
)


FIELDS = [*FIELD_LENGTHS, "properties", "occurred_at"]
FIELD_TYPE = f"struct<{', '.join(f'{name}: variant' for name in FIELDS)}>"

def read_fields(item: Column) -> Column:
    """The known fields of an event, each with its JSON type kept; NULL unless ``item`` is an object."""
    return F.try_variant_get(item, "$", FIELD_TYPE)


def _text(fields: Column, name: str) -> Column:
    return F.try_variant_get(fields[name], "$", "string")


def _kind(fields: Column, name: str) -> Column:
    """``STRING``, ``BIGINT``, ...; NULL for a JSON null and a missing field."""
    return F.nullif(F.schema_of_variant(fields[name]), F.lit("VOID"))


def parse_body(envelopes: DataFrame) -> DataFrame:
    """Adds ``body`` (VARIANT), NULL unless the text is one JSON object and nothing else.

    The parser stops after the first value, so the text is parsed as the first element of
    a list that the hash of the text closes, which no text can hold itself. Of repeated
    keys the last counts; white space around the object is fine.
    """
    require_repeated_keys(envelopes.sparkSession)
    seal = F.sha2("value", 256)
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit(',"'), seal, F.lit('"]')))
    first = F.try_variant_get("wrapped", "$[0]", "variant")
    alone = (F.try_variant_get("wrapped", "$[1]", "string") == seal) & F.schema_of_variant(first).startswith("OBJECT")
    return envelopes.withColumn("wrapped", wrapped).withColumn("body", F.when(alone, first)).drop("wrapped")


def ingest_parse(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, corrupt) envelopes."""
    parsed = parse_body(envelopes)
    return parsed.where(F.col("body").isNotNull()), parsed.where(F.col("body").isNull()).drop("body")


def strict_errors(fields: Column) -> Column:
    """Error codes of one event: name required, types and lengths checked."""
    unnamed = _kind(fields, "event_name").isNull() | (_text(fields, "event_name") == "")
    checks = [F.when(unnamed, "event_name_required")]
    for name, longest in FIELD_LENGTHS.items():
        checks.append(F.when(_kind(fields, name) != "STRING", f"{name}_type"))
        checks.append(F.when(F.char_length(_text(fields, name)) > longest, f"{name}_length"))
    checks.append(F.when(~_kind(fields, "properties").startswith("OBJECT"), "properties_not_object"))
    no_time = event_time(_text(fields, "occurred_at")).isNull() | (_kind(fields, "occurred_at") != "STRING")
    checks.append(F.when(_kind(fields, "occurred_at").isNotNull() & no_time, "occurred_at_not_date"))
    return F.array_compact(F.array(*checks))


def lenient_errors(fields: Column, endpoint: Column | str = "batch") -> Column:
    """Error codes of one event where only a usable name is asked for.

    An event posted alone needs a text that is not empty. In a batch any value counts
    that is not empty: no zero, no false, no empty text, list or object.
    """
    text, kind = _text(fields, "event_name"), _kind(fields, "event_name")
    named = (kind == "STRING") & (text != "")
    empty = (text == "") | (kind != "STRING") & text.rlike(r"^(-?0(\.0*)?([eE][+-]?[0-9]+)?|false)$")
    hollow = F.to_json(fields["event_name"]).isin("[]", "{}") & (kind != "STRING")
    full = kind.isNotNull() & ~F.coalesce(empty, F.lit(False)) & ~F.coalesce(hollow, F.lit(False))
    alone = (F.lit(endpoint) if isinstance(endpoint, str) else endpoint) != "batch"
    usable = F.coalesce(F.when(alone, named).otherwise(full), F.lit(False))
    return F.array_compact(F.array(F.when(~usable, "event_name_required")))


def ingest_validate(items: DataFrame, rules: str = "strict") -> DataFrame:
    """Adds ``errors`` to rows with the ``endpoint`` and ``fields`` of an event."""
    errors = _rule(rules)(F.col("fields"))
    return items.withColumn("errors", errors)


def _rule(rules: str) -> Callable[[Column], Column]:
    """``strict`` or ``lenient``, the latter by the ``endpoint`` of the row."""
    if rules not in ("strict", "lenient"):
        raise ValueError(f"unknown rules {rules!r}")
    return strict_errors if rules == "strict" else lambda fields: lenient_errors(fields, F.col("endpoint"))


def largest_batch(policy: str, max_items: int | None = None) -> int | None:
    """The bound in force: ``max_items`` if given, else 500 events under ``atomic`` and none under ``lenient``."""
    if policy not in ("atomic", "lenient"):
        raise ValueError(f"unknown policy {policy!r}")
    return max_items if max_items is not None else MAX_BATCH if policy == "atomic" else None


def _envelope_error(max_items: int | None) -> Column:
    size = F.size("items")
    batch = F.col("endpoint") == "batch"
    error = (
        F.when(F.col("body").isNull(), "invalid_json")
        .when(batch & F.col("items").isNull(), "events_not_list")
        .when(batch & (size == 0), "events_empty")
    )
    return error if max_items is None else error.when(batch & (size > max_items), "events_too_many")


def _with_items(parsed: DataFrame, max_items: int | None) -> DataFrame:
    listed = F.try_variant_get("body", "$.events", "array<variant>")
    single = F.when(F.col("body").isNotNull(), F.array("body"))
    return parsed.withColumn("items", F.when(F.col("endpoint") == "batch", listed).otherwise(single)).withColumn(
        "envelope_error", _envelope_error(max_items)
    )


def ingest_explode_batch(parsed: DataFrame, max_items: int | None = None) -> DataFrame:
    """One row (request columns, pos, fields) per event of every well-formed envelope."""
    # Not a filter: that would be pushed below the parsing and parse again.
    events = F.when(F.col("envelope_error").isNull(), F.transform("items", read_fields))
    return _with_items(parsed, max_items).select(*REQUEST, F.posexplode(events).alias("pos", "fields"))


def ingest_outcomes(
    envelopes: DataFrame, policy: str = "atomic", max_items: int | None = None
) -> DataFrame:
    """(request columns, pos, fields, errors, value): accepted events have no errors.

    ``atomic``: events are checked strictly, and one bad event rejects its whole
    envelope (one row with ``pos`` NULL). ``lenient``: events without a usable
    name are rejected one by one, the rest of the batch is kept. ``value`` is
    what was rejected, the body or the event; accepted rows do not repeat it.
    Batches are bounded by ``largest_batch``.
    """
    max_items = largest_batch(policy, max_items)
    rule = _rule("strict" if policy == "atomic" else "lenient")

    def outcome(pos: Column, fields: Column, errors: Column, value: Column) -> Column:
        return F.struct(pos.alias("pos"), fields.alias("fields"), errors.alias("errors"), value.alias("value"))

    def check(event: Column) -> Column:
        return F.struct(event["item"].alias("item"), event["fields"].alias("fields"), rule(event["fields"]).alias("errors"))

    events = F.transform("items", lambda item: F.struct(item.alias("item"), read_fields(item).alias("fields")))
    checked = _with_items(parse_body(envelopes), max_items).withColumn("checked", F.transform(events, check))
    rejected = F.when(F.col("envelope_error").isNotNull(), F.array("envelope_error"))
    if policy == "atomic":
        by_position = F.flatten(
            F.transform(
                "checked",
                lambda event, pos: F.transform(
                    event["errors"], lambda code: F.concat(pos.cast("string"), F.lit(":"), code)
                ),
            )
        )
        rejected = rejected.when(F.size(by_position) > 0, by_position)
    no_pos, no_fields = F.lit(None).cast("int"), F.lit(None).cast(FIELD_TYPE)
    whole = F.array(outcome(no_pos, no_fields, F.col("rejected"), F.col("value")))
    single = F.transform(
        "checked",
        lambda event, pos: outcome(
            pos, event["fields"], event["errors"], F.when(F.size(event["errors"]) > 0, F.to_json(event["item"]))
        ),
    )
    return (
        checked.withColumn("rejected", rejected)
        .withColumn("outcome", F.explode(F.when(F.col("rejected").isNotNull(), whole).otherwise(single)))
        .select(*REQUEST, "outcome.*")
    )


def event_id() -> Column:
    """An id that stays the same when a task or a batch runs again."""
    return F.sha2(F.concat_ws(":", "batch_id", F.col("pos").cast("string")), 256)


def ingest_enrich(items: DataFrame, user_fallback: str = "blank") -> DataFrame:
    """Stored event rows from (request columns, pos, fields).

    The signed-in user stands in for a missing user id, with
    ``user_fallback="blank"`` for an empty one as well (``"null"``: only for NULL).
    The address is the first forwarded one, else the peer's. An event without
    a readable time happened on arrival.
    """
    if user_fallback not in ("blank", "null"):
        raise ValueError(f"unknown user_fallback {user_fallback!r}")
    fields = F.col("fields")
    user = _text(fields, "user_id")
    if user_fallback == "blank":
        user = F.nullif(user, F.lit(""))
    forwarded = F.when(F.col("forwarded_for") != "", F.trim(F.split("forwarded_for", ",")[0]))
    plain = [name for name in FIELD_LENGTHS if name != "user_id"]
    return items.select(
        event_id().alias("id"),
        *[_text(fields, name).alias(name) for name in plain],
        F.coalesce(user, F.col("auth_user_id")).alias("user_id"),
        F.when(_kind(fields, "properties").isNotNull(), F.to_json(fields["properties"])).alias("properties"),
        F.coalesce(forwarded, F.col("peer_address")).alias("ip_address"),
        F.col("user_agent"),
        F.coalesce(event_time(_text(fields, "occurred_at")), F.col("arrival_ts")).alias("occurred_at"),
        F.col("arrival_ts").alias("created_at"),
        F.col("arrival_ts").alias("updated_at"),
    )


def accepted_events(outcomes: DataFrame, user_fallback: str = "blank") -> DataFrame:
    return ingest_enrich(outcomes.where(F.size("errors") == 0), user_fallback)


def rejected_events(outcomes: DataFrame) -> DataFrame:
    """What was turned away and why; ``pos`` is NULL for a whole envelope."""
    return outcomes.where(F.size("errors") > 0).select("batch_id", "endpoint", "pos", "value", "arrival_ts", "errors")


def ingest_batch_policy(
    envelopes: DataFrame,
    policy: str = "atomic",
    max_items: int | None = None,
    user_fallback: str = "blank",
) -> tuple[DataFrame, DataFrame]:
    """(stored events, quarantine) of posted envelopes."""
    outcomes = ingest_outcomes(envelopes, policy, max_items)
    return accepted_events(outcomes, user_fallback), rejected_events(outcomes)
