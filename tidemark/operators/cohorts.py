"""Cohorts, retention and churn from bitmaps of active periods.

A user's activity is one bit per period, 60 periods to a word, kept as rows (user, word,
bits). Such tables merge by OR: a day's table is added to the stored one without its
events, and a user with a third of all events leaves one row per task and word. What is
asked of them is read by shifting words and counting bits: users are counted per equal
word first, and only the bits of distinct words are spread out. No join of cohorts with
activity, and no row per user and period, takes place.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_away
from tidemark.operators.activity import as_activity

WORD = 60  # bits in use, so that no shift below meets the sign
FULL = (1 << WORD) - 1
MONDAY = date(1970, 1, 5)  # weeks start on Mondays


def period_of(day: Column, days: int, origin: date) -> Column:
    return F.floor(F.date_diff(day, F.lit(origin)) / days)


def period_start(period: Column, days: int, origin: date) -> Column:
    return F.date_add(F.lit(origin), (period * days).cast("int"))


def activity_words(events: DataFrame, days: int = 7, origin: date = MONDAY) -> DataFrame:
    """(user_id, word, bits): the periods of ``days`` days in which known users have events."""
    period = period_of(F.col("event_date"), days, origin)
    active = as_activity(events).where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
    numbered = active.select("user_id", F.floor(period / WORD).alias("word"), F.pmod(period, F.lit(WORD)).cast("int").alias("bit"))
    return numbered.groupBy("user_id", "word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), "bit")).alias("bits"))


def merge_words(*tables: DataFrame) -> DataFrame:
    """Several tables of words as one; the order and repeats of tables do not matter."""
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("user_id", "word").agg(F.bit_or("bits").alias("bits"))


def user_words(words: DataFrame) -> DataFrame:
    """(user_id, words, first_period, last_period): one row per user; words are sorted and have bits."""
    rows = words.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    first, last = F.col("words")[0], F.element_at("words", -1)
    lowest = F.bit_count((first["bits"].bitwiseAND(-first["bits"])) - 1)
    return rows.select(
        "user_id",
        "words",
        (first["word"] * WORD + lowest).alias("first_period"),
        (last["word"] * WORD + F.length(F.bin(last["bits"])) - 1).alias("last_period"),
    )


def _left(bits: Column, by: Column) -> Column:
    return F.call_function("shiftleft", bits, by.cast("int")).bitwiseAND(F.lit(FULL))


def _right(bits: Column, by: Column) -> Column:
    return F.call_function("shiftright", bits, by.cast("int"))


def _word_at(words: str, number: Column) -> Column:
    return F.coalesce(F.element_at(F.col(words), number), F.lit(0).cast("bigint"))


def _spread(counted: DataFrame, *keys: str) -> DataFrame:
    """(keys, period, users) of (keys, word, bits, users): one row per bit of each distinct word, then per period."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("bit_get", F.col("bits"), i) == 1)
    return (
        counted.select(*keys, "word", "users", F.explode(bits).alias("bit"))
        .groupBy(*keys, (F.col("word") * WORD + F.col("bit")).alias("period"))
        .agg(F.sum("users").alias("users"))
    )


def retention(
    words: DataFrame,
    days: int = 7,
    origin: date = MONDAY,
    registrations: DataFrame | None = None,
) -> DataFrame:
    """The retention triangle: per cohort and number of periods since, how many of its users were active.

    A cohort is the users whose first active period, or period of registration in
    ``registrations`` (user_id, registration_date; the earliest of a user's rows), is the
    same. Users without activity belong to the cohort of their registration; activity
    before it is left out, and so are users without registration. Every cohort has a row
    for each period up to the last one with activity, with 0 where nobody came back.
    """
    users = user_words(words)
    if registrations is None:
        members = users.select(F.col("first_period").alias("cohort"), "words", "last_period")
    else:
        joined = registrations.where(F.col("user_id").isNotNull() & F.col("registration_date").isNotNull())
        joined = joined.groupBy("user_id").agg(F.min("registration_date").alias("registration_date"))
        members = joined.join(users, "user_id", "left").select(period_of(F.col("registration_date"), days, origin).alias("cohort"), "words", "last_period")
    sizes = members.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_users"), F.max("last_period").alias("last"))

    start, bit = F.floor(F.col("cohort") / WORD), F.pmod("cohort", F.lit(WORD))
    by_word = members.where("words IS NOT NULL").select(
        "cohort", F.map_from_entries("words").alias("by_word"), start.alias("start"), bit.alias("bit"), F.element_at("words", -1)["word"].alias("last")
    )

    def since(j: Column) -> Column:
        low = _right(_word_at("by_word", F.col("start") + j), F.col("bit"))
        high = _left(_word_at("by_word", F.col("start") + j + 1), F.lit(WORD) - F.col("bit"))
        return F.struct(j.alias("word"), low.bitwiseOR(high).alias("bits"))

    shifted = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("last") - F.col("start")), since)
    counted = by_word.where("last >= start").select("cohort", F.inline(shifted)).where("bits <> 0")
    active = _spread(counted.groupBy("cohort", "word", "bits").agg(F.count(F.lit(1)).alias("users")), "cohort")
    # One window over one row per cohort.
    newest = F.max("last").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    cells = sizes.withColumn("newest", newest).where("newest >= cohort").select(
        "cohort", "cohort_users", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("newest") - F.col("cohort"))).alias("period")
    )
    there = F.coalesce("users", F.lit(0))
    return cells.join(active, ["cohort", "period"], "left").select(
        period_start(F.col("cohort"), days, origin).alias("cohort_start"),
        F.col("period").cast("int").alias("periods_since"),
        "cohort_users",
        there.alias("active_users"),
        round_half_away(there / F.col("cohort_users"), 4).alias("retention_rate"),
    )


KINDS = ("new_users", "retained_users", "resurrected_users", "churned_users")


def growth_accounting(words: DataFrame, days: int = 7, origin: date = MONDAY) -> DataFrame:
    """Per period: active users as new, retained and resurrected ones, and the churned ones of the period before.

    Each word is compared with itself shifted by one period. Every period from the first
    to the last with activity has a row.
    """
    users = user_words(words)
    start, last = F.col("words")[0]["word"], F.element_at("words", -1)["word"]
    dense = users.select("first_period", F.map_from_entries("words").alias("by_word"), F.explode(F.sequence(start, last + 1)).alias("word"))
    bits = _word_at("by_word", F.col("word"))
    before = _left(bits, F.lit(1)).bitwiseOR(_right(_word_at("by_word", F.col("word") - 1), F.lit(WORD - 1)))
    came = F.col("bits").bitwiseAND(F.bitwise_not("before"))
    first = F.when(
        F.floor(F.col("first_period") / WORD) == F.col("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("first_period", F.lit(WORD)).cast("int"))
    ).otherwise(F.lit(0).cast("bigint"))
    kinds = {
        "new_users": F.col("first"),
        "retained_users": F.col("bits").bitwiseAND(F.col("before")),
        "resurrected_users": came.bitwiseAND(F.bitwise_not("first")),
        "churned_users": F.col("before").bitwiseAND(F.bitwise_not("bits")),
    }
    marked = dense.select("word", bits.alias("bits"), before.alias("before"), first.alias("first"))
    stacked = marked.select("word", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("bits")) for k, v in kinds.items()))))
    counted = stacked.where("bits <> 0").groupBy("kind", "word", "bits").agg(F.count(F.lit(1)).alias("users"))
    per_kind = _spread(counted, "kind").groupBy("period").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("users"))), F.lit(0)).alias(k) for k in KINDS)
    )
    span = users.agg(F.min("first_period").alias("first"), F.max("last_period").alias("last")).where("first IS NOT NULL")
    periods = span.select(F.explode(F.sequence("first", "last")).alias("period"))
    filled = [F.coalesce(k, F.lit(0)).alias(k) for k in KINDS]
    return periods.join(per_kind, "period", "left").select(period_start(F.col("period"), days, origin).alias("period_start"), *filled).withColumn(
        "active_users", F.col("new_users") + F.col("retained_users") + F.col("resurrected_users")
    )


def churn_features(
    words: DataFrame,
    as_of: date,
    days: int = 7,
    origin: date = MONDAY,
    idle: int = 2,
    recent: int = 4,
) -> DataFrame:
    """Per user, from activity up to the period of ``as_of``: span, frequency, gaps, streak, and whether the user is gone.

    first_active_start, last_active_start, active_periods, idle_periods (since the last
    active one), recent_active_periods (of the last ``recent``), longest_gap (idle periods
    between two active ones), current_streak (active periods in a row up to the last
    active one) and is_churned (idle for ``idle`` periods or more).
    """
    now = period_of(F.lit(as_of), days, origin)
    word, bit = F.floor(now / WORD), F.pmod(now, F.lit(WORD))
    upto = F.when(F.col("word") < word, F.lit(FULL)).when(F.col("word") == word, _left(F.lit(1).cast("bigint"), bit + 1) - 1)
    # A shift by the whole word leaves no bit: 0 - 1 is all of them, and FULL cuts it to the word.
    seen = words.withColumn("bits", F.col("bits").bitwiseAND(F.coalesce(upto, F.lit(0).cast("bigint")).bitwiseAND(F.lit(FULL)))).where("bits <> 0")
    inside = F.transform(
        "words",
        lambda w: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("bit_get", w["bits"], i) == 1), lambda i: w["word"] * WORD + i
        ),
    )
    users = user_words(seen).withColumn("periods", F.flatten(inside))
    gaps = F.transform("periods", lambda p, i: F.when(i > 0, p - F.element_at("periods", F.greatest(i, F.lit(1))) - 1).otherwise(0))
    breaks = F.filter(F.transform("gaps", lambda g, i: F.when(g > 0, i)), lambda i: i.isNotNull())
    idle_periods = now - F.col("last_period")
    return users.withColumn("gaps", gaps).select(
        "user_id",
        period_start(F.col("first_period"), days, origin).alias("first_active_start"),
        period_start(F.col("last_period"), days, origin).alias("last_active_start"),
        F.size("periods").alias("active_periods"),
        idle_periods.cast("int").alias("idle_periods"),
        F.size(F.filter("periods", lambda p: p > now - recent)).alias("recent_active_periods"),
        F.array_max("gaps").cast("int").alias("longest_gap"),
        (F.size("periods") - F.coalesce(F.array_max(breaks), F.lit(0))).cast("int").alias("current_streak"),
        (idle_periods >= idle).alias("is_churned"),
    )
