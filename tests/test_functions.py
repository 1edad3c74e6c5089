import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    json_quote,
    label_text,
    nonblank_or,
    python_float_text,
    round_exact,
    round_half_away,
    threshold_band,
)


def numbers(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, x double")


def in_order(df, column):
    return [row[column] for row in df.orderBy("i").collect()]


def test_float_text_is_that_of_the_runtime(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 45.0, 1250.75, 0.001, 0.0001, 0.00012, 0.00001, 1e7, 12345678.25, 1e15, 1e16, 1.5e16, 1e22]
    values += [9999999.99, 10000000.01, 123456789012345.6, -2.5, -12345678.5, 3.3e-9, float("inf"), float("-inf")]
    values += [round(rng.uniform(0, 10 ** rng.randint(0, 13)), 2) for _ in range(2000)]
    shown = in_order(numbers(spark, values).select("i", python_float_text(F.col("x")).alias("t")), "t")
    assert shown == [repr(v) for v in values]
    nan = spark.range(1).select(python_float_text(F.lit(float("nan"))).alias("t")).first()["t"]
    assert nan == "nan"


def test_exact_rounding_is_that_of_the_runtime(spark):
    rng = random.Random(3)
    values = [h / 10000 * 100 for h in range(0, 10001, 5)] + [i / 8 for i in range(400)]
    values += [rng.uniform(0, 1e6) for _ in range(2000)]
    df = numbers(spark, values).select(
        "i", round_exact(F.col("x"), 1).alias("one"), round_exact(F.col("x"), 2).alias("two")
    )
    assert in_order(df, "one") == [round(v, 1) for v in values]
    assert in_order(df, "two") == [round(v, 2) for v in values]


def test_exact_rounding_with_ties_up(spark):
    values = [12.25, 12.35, 0.05, 31.25]
    df = numbers(spark, values).select("i", round_exact(F.col("x"), 1, "up").alias("r"))
    # 12.35 lies just below the half, 0.05 just above it
    assert in_order(df, "r") == [12.3, 12.3, 0.1, 31.3]
    with pytest.raises(ValueError):
        round_exact(F.col("x"), 1, "down")


def test_half_away_rounds_the_scaled_double(spark):
    # 1.005 * 100 is 100.49999999999999 in doubles
    df = numbers(spark, [1.005, 2.01 / 2, 0.00005, 2.5, 1.015]).select("i", round_half_away(F.col("x"), 2).alias("r"))
    want = [math.floor(v * 100 + 0.5) / 100 for v in [1.005, 2.01 / 2, 0.00005, 2.5, 1.015]]
    assert in_order(df, "r") == want
    assert want[0] == 1.0


def test_text_helpers(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "a string")
    assert [r[0] for r in df.select(nonblank_or(F.col("a"), "d")).collect()] == ["d", "d", "x"]
    quoted = spark.createDataFrame([('a "b" \\ é\n',), (None,)], "a string").select(json_quote(F.col("a"))).collect()
    assert [r[0] for r in quoted] == ['"a \\"b\\" \\\\ é\\n"', "null"]


def test_labels_are_sorted_and_plain(spark):
    labels = F.create_map(F.lit("z"), F.lit('q"'), F.lit("a"), F.lit("1"))
    row = spark.range(1).select(label_text(labels).alias("plain"), label_text(labels, escape=True).alias("safe")).first()
    assert row["plain"] == 'a="1",z="q""'
    assert row["safe"] == 'a="1",z="q\\""'


def test_bands(spark):
    df = numbers(spark, [0.0, 14.9, 15.0, 29.9, 30.0, 80.0]).select(
        "i", threshold_band(F.col("x"), [15, 30], ["red", "amber", "green"]).alias("b")
    )
    assert in_order(df, "b") == ["red", "red", "amber", "amber", "green", "green"]


def test_negative_values_round_like_their_opposites(spark):
    df = spark.createDataFrame([(-0.125,), (-2.5,), (-1.005,), (0.125,)], "x double")
    for ties, want in {"even": [-0.12, -2.5, -1.0, 0.12], "up": [-0.13, -2.5, -1.0, 0.13]}.items():
        assert [r[0] for r in df.select(round_exact(F.col("x"), 2, ties)).collect()] == want
