"""Raw tables -> standardized tables (projection and filter only; no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fold_platform, round_half_away
from tidemark.functions.times import utc_time
from tidemark.schemas import MONEY

# Defaults and the words that mean a successful payment.
USER_DEFAULTS = {"role": "customer", "status": "active", "platform": "web", "country_code": "BR"}
EVENT_DEFAULTS = {"session_id": "unknown_session", "event_category": "general", "app_version": "1.0.0"}
PAYMENT_DEFAULTS = {"currency": "BRL", "status": "completed", "payment_method": "unknown"}
SUCCESS_WORDS = ["completed", "success", "paid", "approved"]


def _text_or(name: str, defaults: dict[str, str]):
    return F.coalesce(F.col(name).cast("string"), F.lit(defaults[name]))


def _ntz(name: str):
    return utc_time(F.col(name))


def _money(name: str) -> Column:
    """An amount with two decimals, 0 if missing.

    Floating point is scaled and rounded as such (1.005 is 1.00, as its double lies below);
    decimals and text never become floating point.
    """
    amount = F.col(name)
    scaled = round_half_away(amount.cast("double"), 2).cast(MONEY)
    exact = F.when(F.typeof(amount).isin("double", "float"), scaled).otherwise(amount.cast(MONEY))
    return F.coalesce(exact, F.lit(0).cast(MONEY))


def _update_time():
    return F.coalesce(_ntz("updated_at"), _ntz("created_at"))


def stg_users(raw: DataFrame) -> DataFrame:
    """One row per raw user with an id. Repeated user ids pass through.

    The platform is lower-cased only: not trimmed and not folded as for events.
    """
    return raw.where(F.col("id").isNotNull()).select(
        F.coalesce(F.col("user_id").cast("string"), F.col("id").cast("string")).alias("user_id"),
        F.trim(F.lower("email")).alias("email"),
        F.lower(_text_or("role", USER_DEFAULTS)).alias("user_role"),
        F.lower(_text_or("status", USER_DEFAULTS)).alias("user_status"),
        F.lower(_text_or("platform", USER_DEFAULTS)).alias("platform"),
        _text_or("country_code", USER_DEFAULTS).alias("country_code"),
        _ntz("created_at").alias("created_at"),
        _update_time().alias("updated_at"),
        F.to_date(_ntz("created_at")).alias("registration_date"),
    )


@dataclass(frozen=True)
class Derivation:
    """How a staged table comes from its raw one: which rows are kept, and the new columns."""

    raw: str
    kept: Column
    columns: Mapping[str, Column]

    def apply(self, raw: DataFrame) -> DataFrame:
        return raw.where(self.kept).select(*[column.alias(name) for name, column in self.columns.items()])


def event_derivation(event_time: str = "created_at") -> Derivation:
    return Derivation(
        "raw_analytics_events",
        F.col("id").isNotNull() & F.col("event_name").isNotNull(),
        {
            "event_id": F.col("id").cast("string"),
            "user_id": F.col("user_id").cast("string"),
            "session_id": _text_or("session_id", EVENT_DEFAULTS),
            "event_name": F.lower(F.trim("event_name")),
            "event_category": F.lower(_text_or("event_category", EVENT_DEFAULTS)),
            "platform": fold_platform(F.col("platform")),
            "app_version": _text_or("app_version", EVENT_DEFAULTS),
            "properties_json": F.col("properties_json"),
            "created_at": _ntz(event_time),
            "event_date": F.to_date(_ntz(event_time)),
        },
    )


def transaction_derivation() -> Derivation:
    succeeded = F.lower("status").isin(SUCCESS_WORDS)
    return Derivation(
        "raw_transactions",
        F.col("id").isNotNull(),
        {
            "transaction_id": F.col("id").cast("string"),
            "user_id": F.col("user_id").cast("string"),
            "amount": _money("amount"),
            "currency": F.upper(_text_or("currency", PAYMENT_DEFAULTS)),
            "status": F.lower(_text_or("status", PAYMENT_DEFAULTS)),
            "payment_method": F.lower(_text_or("payment_method", PAYMENT_DEFAULTS)),
            "created_at": _ntz("created_at"),
            "updated_at": _update_time(),
            "transaction_date": F.to_date(_ntz("created_at")),
            "is_successful": F.when(succeeded, 1).otherwise(0),
        },
    )


def stg_events(raw: DataFrame, event_time: str = "created_at") -> DataFrame:
    """One row per raw event with an id and a name; a blank name is kept as ''."""
    return event_derivation(event_time).apply(raw)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """One row per raw transaction with an id.

    The success flag looks at the raw status: a missing one is shown as
    ``completed`` and yet does not count as successful.
    """
    return transaction_derivation().apply(raw)


def same_key_derivations() -> dict[str, Derivation]:
    """Staged tables whose unique id is the raw one as text."""
    return {"stg_events": event_derivation(), "stg_transactions": transaction_derivation()}
