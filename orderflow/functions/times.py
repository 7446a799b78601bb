"""Clock times as ``HH:mm:ss`` text, hours and parts of the day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_CLOCK_24 = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"
_CLOCK_12 = r"^(0?[1-9]|1[0-2]):[0-5]?\d:[0-5]?\d\s+[AaPp][Mm]$"
_WHITE = " \t\n\r\x0b\x0c"
_CLOCK_FULL_12 = r"^(0[1-9]|1[0-2]):[0-5]\d:[0-5]\d [AaPp][Mm]$"
_CLOCK_FULL = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
DAY_SECONDS = 86400


def stripped(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(_WHITE))


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def clock(text: Column) -> Column:
    """12- or 24-hour clock text to ``HH:mm:ss``; null when it is neither.

    Padded text, which is nearly all of it, is cut at fixed places. Only text with
    single digits or extra white space is taken apart piece by piece.
    """
    padded_12 = F.concat(_two(F.substring(text, 1, 2).try_cast("int") % 12
                              + F.when(F.lower(F.right(text, F.lit(2))) == "pm", 12).otherwise(0)),
                         F.substring(text, 3, 6))
    return (F.when(text.rlike(_CLOCK_FULL), text).when(text.rlike(_CLOCK_FULL_12), padded_12)
            .otherwise(_loose_clock(stripped(text))))


def _loose_clock(t: Column) -> Column:
    part = lambda i: F.split_part(t, F.lit(":"), F.lit(i))
    joined = lambda hour, second: F.concat(_two(hour), F.lit(":"), _two(part(2)), F.lit(":"), _two(second))
    afternoon = F.when(F.lower(F.right(t, F.lit(2))) == "pm", 12).otherwise(0)
    hour_12 = part(1).try_cast("int") % 12 + afternoon
    second_12 = stripped(F.left(part(3), F.length(part(3)) - 2))
    return F.when(t.rlike(_CLOCK_24), joined(part(1), part(3))).when(t.rlike(_CLOCK_12), joined(hour_12, second_12))


def day_seconds(time: Column) -> Column:
    """Seconds since midnight of ``HH:mm:ss`` text, null for other text."""
    number = lambda start: F.substring(time, start, 2).try_cast("int")
    return F.when(time.rlike(_CLOCK_FULL), number(1) * 3600 + number(4) * 60 + number(7))


def clock_of_seconds(seconds: Column) -> Column:
    """``HH:mm:ss`` text of a number of seconds, wrapping at midnight."""
    s = F.pmod(seconds, F.lit(DAY_SECONDS)).cast("int")
    unit = lambda size: F.floor(s / size).cast("int") % 60
    colon = F.lit(":")
    return F.concat(_two(F.floor(s / 3600).cast("int")), colon, _two(unit(60)), colon, _two(s % 60))


def hour(time: Column) -> Column:
    """Hour 0-23 of ``HH:mm:ss`` text, null for other text."""
    return F.when(time.rlike(_CLOCK_FULL), F.substring(time, 1, 2).try_cast("int"))


def day_part(hour_of_day: Column, breakfast_start: int = 5) -> Column:
    """Name of the part of the day; breakfast starts at 5 (live rule) or 4 (alternative rule)."""
    h = hour_of_day
    return (F.when((h >= 23) | (h < breakfast_start), "Late night")
            .when(h < 11, "Breakfast").when(h < 15, "Lunch").when(h < 19, "Snack").when(h < 23, "Dinner"))
