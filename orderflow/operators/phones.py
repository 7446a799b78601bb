"""Phone numbers of orders: daily use, cleaning, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.contract import MISSING_PHONE
from orderflow.functions.phones import clean_phone, phone_is_valid, phone_number
from orderflow.operators.shape import column
from orderflow.operators.skew import RARE, key_counts, lookup_join, plain_join
from orderflow.sources.scratch import staged

RAW_PHONE, DAILY, CLEAN, VALID = "CombinedNumber", "transactions_today", "CleanedPhoneNumber", "Valid"
_BLOCKED = "_blocked"


def _raw(df: DataFrame) -> DataFrame:
    return df.withColumn(RAW_PHONE, F.coalesce(F.col("MobileNo"), F.col("PhoneNo")))


def with_daily_count(df: DataFrame, counted: DataFrame | None = None, spread: str = "Header_Id", rare: int = RARE) -> DataFrame:
    """Orders per raw number and day, null numbers counted together.

    ``counted`` may name the rows to count, where they can be read more cheaply. Only
    counts above one are looked up; up to ``rare`` of them go to all tasks, and the orders stay where they are.
    """
    keys = [RAW_PHONE, "InvoiceDate"]
    counts = key_counts(df if counted is None else counted, keys, DAILY)
    repeated = staged(counts.filter(F.col(DAILY) > 1), "repeated-numbers")
    few = repeated.count() <= rare
    joined = plain_join(df, F.broadcast(repeated), keys, null_safe=True) if few else lookup_join(df, repeated, keys, null_safe=True, spread=spread)
    return joined.withColumn(DAILY, F.coalesce(DAILY, F.lit(1).cast("bigint")))


def validate_phones(df: DataFrame, blocklist: DataFrame | None = None, strict: bool = False,
                    counted: DataFrame | None = None) -> DataFrame:
    """Adds the raw number, its daily count, the cleaned number and whether it is valid.

    The feed's number comes first, then the till's. A number used four times or
    more on a day is not valid. ``blocklist`` (one column) makes its numbers
    invalid and removes them, which is off by default. ``counted`` may be an
    earlier form of ``df`` with the same numbers and days, to count in place of it.
    """
    daily = with_daily_count(_raw(df), None if counted is None else _raw(counted))
    daily = daily.withColumn(CLEAN, clean_phone(F.col(RAW_PHONE)))
    valid = phone_is_valid(F.col(CLEAN), F.col(DAILY), strict)
    number = phone_number(F.col(CLEAN), F.col(DAILY))
    checked = daily.withColumns({VALID: valid, CLEAN: number})
    if blocklist is not None:
        blocked = blocklist.select(column(blocklist.columns[0]).alias(CLEAN)).dropna().distinct() \
            .withColumn(_BLOCKED, F.lit(True))
        checked = lookup_join(checked, blocked, [CLEAN], spread="Header_Id")
        free = F.col(_BLOCKED).isNull()
        checked = checked.withColumns({VALID: F.col(VALID) & free, CLEAN: F.when(free, F.col(CLEAN))}).drop(_BLOCKED)
    return checked.withColumn(CLEAN, F.coalesce(CLEAN, F.lit(MISSING_PHONE)))
