"""Expressions over the item and payment arrays of one order.

One order's array is bounded by its input record, so working inside the array
needs no shuffle and no regrouping of exploded rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderflow.contract import GIFT_CARD_MODE
from orderflow.functions.amounts import amount


def any_with_promo(items: Column) -> Column:
    """Some item has a promotion; null for a missing array."""
    return F.exists(items, lambda i: i["Promono"].isNotNull())


def any_without_promo(items: Column) -> Column:
    """Some item has no promotion; null for a missing array."""
    return F.exists(items, lambda i: i["Promono"].isNull())


def any_non_veg(items: Column) -> Column:
    """Some item's food type says ``Non Veg``."""
    return F.coalesce(F.exists(items, lambda i: F.contains(i["FoodType"], F.lit("Non Veg"))), F.lit(False))


def payment_modes(payments: Column) -> Column:
    """Payment modes in order, as text ``Cash, Card``; null for an order without payments."""
    modes = F.transform(payments, lambda p: F.regexp_replace(p["Mode"], r"[\[\]]", ""))
    return F.when(F.size(payments) > 0, F.array_join(modes, ", "))


def has_gift_card(payments: Column, mode: str = GIFT_CARD_MODE) -> Column:
    """Some payment was made by gift card; null for an order without payments."""
    return F.when(F.size(payments) > 0, F.exists(payments, lambda p: p["Mode"].eqNullSafe(F.lit(mode))))


def with_parents(items: Column, child: str = "TOPPING", parent: str = "PIZZA") -> Column:
    """Each item with the number of the last pizza before it if it is a topping, else null.

    Pizzas cut the array into stretches; each stretch repeats the number of the pizza
    it begins with. Every array is walked once, so the work grows with the items.
    """
    pizza = lambda i: F.coalesce((i["ItemCatagory"] == parent) & i["ItemNo"].isNotNull(), F.lit(False))
    marks = F.array_join(F.transform(items, lambda i: F.when(pizza(i), "P").otherwise("-")), "")
    numbers = F.transform(F.filter(items, pizza), lambda i: i["ItemNo"])
    before = F.array(F.lit(None).cast("string"))
    last = F.flatten(F.zip_with(F.split(marks, "P"), F.concat(before, numbers), lambda stretch, number: F.array_repeat(
        number, F.length(stretch) + F.when(number.isNull(), 0).otherwise(1))))
    return F.zip_with(items, last, lambda i, number: F.struct(
        i.alias("item"), F.when(i["ItemCatagory"] == child, number).alias("parent")))


def gift_card_amount(payments: Column, mode: str = GIFT_CARD_MODE) -> Column:
    """Gift-card total; other payments count as zero and unreadable amounts are skipped."""
    paid = F.transform(payments, lambda p: F.when(p["Mode"] == mode, amount(p["Amount"], negate=False))
                       .otherwise(F.lit(0.0)))
    known = F.filter(paid, lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda total, v: total + v))


def first_scalar(df: DataFrame, name: str) -> Column:
    """A column as a scalar: itself, the first array element or the first struct field."""
    kind = df.schema[name].dataType
    value = F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType):
        return F.try_element_at(value, F.lit(1))
    if isinstance(kind, T.StructType):
        return value[kind.fields[0].name]
    return value
