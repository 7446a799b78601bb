"""Mobile number cleaning and validation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderflow.functions.times import stripped

MAX_DAILY_ORDERS = 4
_FIRST_DIGITS = ["9", "8", "7", "6"]
_LONG_WITH_PREFIX = r"^91[6789]\d{10}$"
_STRICT = r"^[6-9]\d{9}$"


def clean_phone(text: Column) -> Column:
    """Number without spaces and without a leading ``0``, ``91`` or ``+91`` of the right length."""
    n = stripped(F.replace(text, F.lit(" "), F.lit("")))
    rest = lambda start: F.substr(n, F.lit(start))
    return (F.when((F.length(n) == 11) & n.startswith("0"), rest(2))
            .when((F.length(n) == 12) & n.startswith("91"), rest(3))
            .when((F.length(n) == 13) & n.startswith("+91"), rest(4))
            .otherwise(n))


def phone_number(cleaned: Column, daily_orders: Column) -> Column:
    """Number to keep: a thirteen-digit ``91`` number loses its prefix unless it is over the daily limit."""
    over = daily_orders >= MAX_DAILY_ORDERS
    return F.when(~over & cleaned.rlike(_LONG_WITH_PREFIX), F.substr(cleaned, F.lit(3))).otherwise(cleaned)


def phone_is_valid(cleaned: Column, daily_orders: Column, strict: bool = False) -> Column:
    """Whether a cleaned number counts as valid; null numbers and busy numbers do not.

    The default looks at the first digit of a ten-character number and accepts a
    thirteen-digit ``91`` number. ``strict`` wants ten digits starting with 6-9.
    """
    if strict:
        shape = cleaned.rlike(_STRICT)
    else:
        shape = (((F.length(cleaned) == 10) & F.substring(cleaned, 1, 1).isin(_FIRST_DIGITS))
                 | cleaned.rlike(_LONG_WITH_PREFIX))
    return F.coalesce(shape & (daily_orders < MAX_DAILY_ORDERS), F.lit(False))
