"""Money and quantity text to numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def amount(text: Column, negate: bool = True) -> Column:
    """``'-1,234.50'`` to ``1234.5``; text that is no number becomes null.

    Sales arrive negative, so the sign is flipped unless ``negate=False``.
    Adding zero turns ``-0.0`` into ``0.0``.
    """
    number = _plain(text)
    return (-number if negate else number) + F.lit(0.0)


def quantity(text: Column) -> Column:
    """``'-1,002.00'`` to ``1002``: absolute whole number, null when unreadable."""
    return F.abs(_plain(text)).try_cast("int")


def tax(sgst: Column, cgst: Column) -> Column:
    """Sum of the two tax parts; null when either is missing."""
    return sgst + cgst
