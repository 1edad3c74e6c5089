"""Rounding and number text that must agree to the last digit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 splits a double into two halves whose products carry no rounding error.
SPLITTER = 134217729.0


def round_half_away(x: Column, digits: int) -> Column:
    """Scale, round halves away from zero, scale back - all on doubles.

    ``F.round(x, digits)`` rounds the printed decimal instead, which differs
    where ``x * 10**digits`` lands on a half only after its own rounding.
    """
    scale = F.lit(10.0**digits)
    return F.round(x * scale, 0) / scale


def round_exact(x: Column, digits: int, ties: str = "even") -> Column:
    """Round the exact binary value of a double; a negative one as its opposite.

    ``ties="even"`` gives the number language runtimes print for round(x, n),
    ``ties="up"`` the one of fixed-point formatting in browsers.
    """
    if ties not in ("even", "up"):
        raise ValueError(f"ties must be 'even' or 'up', not {ties!r}")
    scale = F.lit(10.0**digits)
    sign, x = F.when(x < 0, F.lit(-1.0)).otherwise(F.lit(1.0)), F.abs(x)
    product = x * scale
    carry = x * F.lit(SPLITTER)
    high = carry - (carry - x)
    low = x - high
    # x * scale == product + error exactly
    error = (high * scale - product) + low * scale
    whole = F.floor(product)
    rest = product - whole.cast("double")
    tie_goes_up = (whole % 2 == 1) if ties == "even" else F.lit(True)
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & tie_goes_up)))
    return sign * ((whole + F.when(up, 1).otherwise(0)).cast("double") / scale)


def python_float_text(x: Column) -> Column:
    """A double as text: ``45.0``, ``1250.75``, ``12345678.5``, ``1e+16``, ``5e-05``.

    Casting gives plain digits only for 1e-3 <= |x| < 1e7, this for 1e-4 <= |x| < 1e16.
    """
    size = F.abs(x)
    java = x.cast("string")

    def plain(decimal: str) -> Column:
        digits = F.regexp_replace(java.try_cast(decimal).cast("string"), "0+$", "")
        return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)

    exponent = F.regexp_replace(F.regexp_replace(java, r"\.0E", "E"), r"E(\d)", "e+$1")
    exponent = F.regexp_replace(F.regexp_replace(exponent, "E-", "e-"), r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e7) & (size < 1e16), plain("decimal(38,20)"))
        .when((size >= 1e-4) & (size < 1e-3), plain("decimal(38,30)"))
        .otherwise(exponent)
    )
