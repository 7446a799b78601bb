"""Date text in several spellings, calendar parts and date text output.

Each spelling is recognised by its shape first, so a value is parsed once with
the one pattern that can fit. Trying the patterns in turn would raise and
swallow a parse exception per row and pattern. Texts of no known shape are read
token by token.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The shapes a date may have and the pattern that reads each.
DATE_SHAPES = {
    r"^\d{1,2}-\d{1,2}-\d{2}$": "d-M-yy",
    r"^\d{1,2}-\d{1,2}-\d{4}$": "d-M-yyyy",
    r"^\d{1,2}/\d{1,2}/\d{2}$": "M/d/yy",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
}
# Fixed value: two-digit years up to this one are in the 2000s, later ones in the 1900s.
LAST_SHORT_YEAR = 2068

# The month names, as their first three letters and what may follow.
MONTHS = {"jan": "uary", "feb": "ruary", "mar": "ch", "apr": "il", "may": "", "jun": "e", "jul": "y", "aug": "ust", "sep": "t(?:ember)?",
          "oct": "ober", "nov": "ember", "dec": "ember"}
# What may stand around the parts of a date, and what is put in its place.
_ZONE = r"(?:\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2}))?"
_NOISE = [
    (r"(?:(?<=\d)t|(?<!\d))\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:\s*[ap]\.?m\b\.?)?" + _ZONE, " "),
    (r"(?<!\d)\d{1,2}\s*[ap]\.?m\b\.?", " "),
    (r"\b(?:mon|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:r(?:s(?:day)?)?)?|fri|sat(?:urday)?|sun)(?:day)?\b", " "),
    (r"(?<=\d)(?:st|nd|rd|th)\b", " "),
    (r"\b(?:of|on|at|and|the)\b", " "),
]
# A month name becomes m and its number; then tokens stand with one space between.
_NAMES = [*[(f"(?<![a-z]){head}(?:{tail})?(?![a-z])", f" m{number:02d} ") for number, (head, tail) in enumerate(MONTHS.items(), 1)],
          (r"[ .,;/'-]+", " "), (r"^ | $", ""), (r"^(\d{4})(\d{2})(\d{2})(?:\d{4}|\d{6})?$", "$1 $2 $3"), (r"^(\d{2})(\d{2})(\d{2})$", "$1 $2 $3")]
# Three tokens become year-month-day; the mark at the end keeps later patterns from fitting as well.
_DONE, _YEAR, _SMALL = "!", r"(\d{3,}|3[2-9]|[4-9]\d)", r"(\d{1,2})"
_ORDERS = [(f"^{pattern}$", f"{by}{_DONE}") for pattern, by in [
    (rf"m(\d\d) {_YEAR} {_SMALL}", "$2-$1-$3"), (rf"m(\d\d) {_SMALL} (\d+)", "$3-$1-$2"),
    (rf"{_YEAR} m(\d\d) {_SMALL}", "$1-$2-$3"), (rf"{_SMALL} m(\d\d) (\d+)", "$3-$2-$1"),
    (rf"{_SMALL} {_YEAR} m(\d\d)", "$2-$3-$1"), (rf"(\d+) {_SMALL} m(\d\d)", "$1-$3-$2"),
    (rf"{_YEAR} {_SMALL} {_SMALL}", "$1-$2-$3"), (rf"(1[3-9]|2\d|3[01]) {_SMALL} (\d+)", "$3-$2-$1"), (rf"{_SMALL} {_SMALL} (\d+)", "$3-$1-$2")]]
_LATE = "|".join(f"{y:02d}" for y in range(LAST_SHORT_YEAR - 2000 + 1))
_YEARS = [(f"^({_LATE})-(.*){_DONE}$", f"20$1-$2{_DONE}"), (rf"^(\d\d)-(.*){_DONE}$", f"19$1-$2{_DONE}")]

FLOW_FORMAT = "yyyy/MM/dd"
OUTPUT_FORMAT = "yyyy-MM-dd"
SLASHED = r"^\d{4}/\d{2}/\d{2}$"
_SHORT_SLASHED = r"^\d{2}/\d{2}/\d{2}$"


def _parsed(text: Column, pattern: str) -> Column:
    day = F.try_to_timestamp(text, F.lit(pattern)).cast("date")
    if "yyyy" in pattern:
        return day
    return F.when(F.year(day) > LAST_SHORT_YEAR, F.add_months(day, -1200)).otherwise(day)


def known_date(text: Column, shapes: Mapping[str, str] = DATE_SHAPES) -> Column:
    """Date from text in one of the spellings of ``shapes``, null when none fits."""
    chain = None
    for shape, pattern in shapes.items():
        branch = _parsed(text, pattern)
        chain = F.when(text.rlike(shape), branch) if chain is None else chain.when(text.rlike(shape), branch)
    return chain


def free_date(text: Column) -> Column:
    """Date from free-form text: ``5th of March 2024``, ``Tue, Mar 5 24 10:11 pm``, ``2024.03.05T10:11Z``, ``20240305``.

    Clock time, weekday, ordinal ends and filler words are taken out; what is left
    has to be three tokens, at most one of them a month name, or one run of digits.
    A token above 31 or of more than two digits is the year. Else a name comes
    before or between day and year, or after year and day; without a name the order
    is month, day, year, or day first if the first is above 12. A text that names
    no year, has anything else in it or is no day of the calendar is null.

    The grammar is one chain of replacements, each of which takes the text that the
    one before it left. It stands in a lambda, which keeps it out of the code made
    for the rest of the stage: compiled with it, it would make that code too large to
    run fast, for the sake of few rows.
    """
    def read(plain: Column) -> Column:
        for pattern, by in [*_NOISE, *_NAMES, *_ORDERS, *_YEARS]:
            plain = F.regexp_replace(plain, pattern, by)
        day = F.regexp_extract(plain, rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}}){_DONE}$", 1)
        return F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("yyyy-M-d")).cast("date")

    # A day has three digits at least; texts without are not worth the chain.
    worth = F.when(text.rlike(r"\d\D*\d\D*\d"), F.lower(F.trim(text)))
    return F.get(F.transform(F.when(worth.isNotNull(), F.array(worth)), read), F.lit(0))


def any_date(text: Column, shapes: Mapping[str, str] = DATE_SHAPES) -> Column:
    """Date from text in any of the known spellings, else in free form, null when neither fits."""
    return F.coalesce(known_date(text, shapes), free_date(text))


def any_date_text(text: Column) -> Column:
    """The date of ``any_date`` as ``yyyy/MM/dd`` text."""
    return F.date_format(any_date(text), FLOW_FORMAT)


def flow_date(text: Column) -> Column:
    """Date from ``yyyy/MM/dd`` text, null for anything else.

    A cast reads the one form that is left by the shape and the length much faster than a pattern would.
    """
    return F.when(text.rlike(SLASHED) & (F.length(text) == 10), F.replace(text, F.lit("/"), F.lit("-")).try_cast("date"))


def short_date_text(text: Column) -> Column:
    """``MM/dd/yy`` text to ``yyyy/MM/dd`` text; years are all taken as 20xx."""
    day = F.when(text.rlike(_SHORT_SLASHED), F.try_to_timestamp(text, F.lit("MM/dd/yy")).cast("date"))
    return F.date_format(day, FLOW_FORMAT)


def output_date_text(text: Column) -> Column:
    """``yyyy/MM/dd`` text to ``yyyy-MM-dd`` text."""
    return F.date_format(flow_date(text), OUTPUT_FORMAT)


def slashed(text: Column) -> Column:
    """Date text with ``/`` in place of ``-``."""
    return F.replace(text, F.lit("-"), F.lit("/"))


def compact(text: Column) -> Column:
    """Date text without its slashes, for use inside keys."""
    return F.replace(text, F.lit("/"), F.lit(""))


def week_number(day: Column) -> Column:
    """Weeks since the Monday on or before 1 January, counted from 1 (not the ISO week)."""
    first_monday = F.date_trunc("week", F.make_date(F.year(day), F.lit(1), F.lit(1))).cast("date")
    return (F.floor(F.datediff(day, first_monday) / 7) + 1).cast("int")


def week_day(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def state_date(text: Column) -> Column:
    """Date from the ``yyyy-MM-dd`` text kept in state tables; blank becomes null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"),
                  F.try_to_timestamp(text, F.lit(OUTPUT_FORMAT)).cast("date"))


def state_date_text(day: Column, missing: str | None = None) -> Column:
    """State-table text of a date; ``missing`` stands for null where it is given."""
    text = F.date_format(day, OUTPUT_FORMAT)
    return text if missing is None else F.coalesce(text, F.lit(missing))
