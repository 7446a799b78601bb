"""Flat item and payment rows out of nested orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.contract import (ITEM_FIELDS, LINE_AMOUNT_COLUMNS, LINE_COLUMNS, LINE_HEADER_COLUMNS, LINE_RENAMES,
                                PAYMENT_COLUMNS, PAYMENT_HEADER_COLUMNS, PAYMENT_RENAMES)
from orderflow.functions.amounts import amount, quantity, tax
from orderflow.functions.codes import item_base
from orderflow.functions.dates import short_date_text
from orderflow.functions.nested import gift_card_amount, has_gift_card, payment_modes, with_parents
from orderflow.operators.shape import conform
from orderflow.operators.skew import by_repeats

ITEMS, PAYMENTS = "ItemDetails.Items", "PaymentsDetails.Payments"
ITEM_COUNT, PAYMENT_COUNT = "Item_Count", "Payment_Count"
ITEM_START, PAYMENT_START = "Item_Start", "Payment_Start"
RECEIPT = ["OrderId", "StoreCode"]
_AT, _ROW = "_at", "_row"
_PAID = ["Amount", "Date", "Mode", "TenderType"]


def with_sizes(orders: DataFrame) -> DataFrame:
    """Adds how many items and payments an order has; none for a missing array."""
    size = lambda array: F.coalesce(F.array_size(F.col(array)), F.lit(0))
    return orders.withColumns({ITEM_COUNT: size(ITEMS), PAYMENT_COUNT: size(PAYMENTS)})


def with_line_starts(orders: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """How many items and payments come before each order under the same receipt.

    Lines are numbered per (receipt, store) over all its days. The counts of whole
    orders are summed, and only orders that share a receipt are sorted. With one row
    per order key a receipt has at most one row per day here. ``repeated`` may give the
    ``repeated_keys`` of the receipts, where they can be read more cheaply.
    """
    sized = orders if ITEM_COUNT in orders.columns else with_sizes(orders)
    first = lambda rows: rows.withColumns({s: F.lit(0).cast("bigint") for s in (ITEM_START, PAYMENT_START)})
    return by_repeats(sized, RECEIPT, first, _summed_starts, repeated=repeated)


def _summed_starts(sized: DataFrame) -> DataFrame:
    before = (Window.partitionBy(*RECEIPT).orderBy("Enriched_Order_Date", "Header_Id")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = lambda count: F.coalesce(F.sum(count).over(before), F.lit(0))
    return sized.withColumns({ITEM_START: start(ITEM_COUNT), PAYMENT_START: start(PAYMENT_COUNT)})


def _line_number(start: str) -> Column:
    return (F.col(start) + F.col(_AT) + 1).cast("int")


def _ensure(orders: DataFrame, start: str) -> DataFrame:
    return orders if start in orders.columns else with_line_starts(orders)


def unfold_items(orders: DataFrame, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per item, with its place and the pizza it belongs to; fields nobody reads are not carried on."""
    unfold = F.posexplode_outer if outer else F.posexplode
    rows = orders.select(*keep, unfold(with_parents(F.col(ITEMS))).alias(_AT, _ROW))
    fields = [F.col(f"{_ROW}.item.{f.name}").alias(f.name) for f in ITEM_FIELDS.fields]
    return rows.select(*keep, _AT, *fields, F.col(f"{_ROW}.parent").alias("Parent_ID"))


def _numbered(rows: DataFrame, keep: list[str], fields: list[str], start: str, name: str) -> DataFrame:
    return (rows.withColumn("Line_No", _line_number(start))
            .select(*keep, *fields, "Line_No", F.concat_ws("_", "Header_Id", "Line_No").alias(name)))


def number_items(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of ``unfold_items`` that have the start of their order, with their number and their key."""
    return _numbered(rows, keep, [*ITEM_FIELDS.fieldNames(), "Parent_ID"], ITEM_START, "Line_Id")


def flatten_items(orders: DataFrame, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per item with its number, its key and the pizza it belongs to.

    Orders without items give no row unless ``outer``. The parent is found inside
    the order's array, so flattening needs no shuffle.
    """
    return number_items(unfold_items(_ensure(orders, ITEM_START), [*keep, ITEM_START], outer), keep)


def line_facts(orders: DataFrame, outer: bool = False) -> DataFrame:
    """The line output: amounts as numbers, base, parent, tax, contract names."""
    return conform_lines(flatten_items(orders, LINE_HEADER_COLUMNS, outer))


def conform_lines(rows: DataFrame) -> DataFrame:
    """The line output of numbered items."""
    numbers = {c: amount(F.col(c)) for c in LINE_AMOUNT_COLUMNS}
    rows = rows.withColumns({**numbers, "Quantity": quantity(F.col("Quantity")),
                             "Base": item_base(F.col("ItemCatagory"), F.col("ProductGroup"))})
    return conform(rows.withColumn("Tax_Amount", tax(F.col("SGST"), F.col("CGST"))), LINE_RENAMES, LINE_COLUMNS)


def unfold_payments(orders: DataFrame, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per payment, with its place."""
    unfold = F.posexplode_outer if outer else F.posexplode
    rows = orders.select(*keep, unfold(F.col(PAYMENTS)).alias(_AT, _ROW))
    return rows.select(*keep, _AT, *[F.col(f"{_ROW}.{f}").alias(f"Payment_{f}") for f in _PAID])


def number_payments(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of ``unfold_payments`` that have the start of their order, with their number and their key."""
    return _numbered(rows, keep, [f"Payment_{f}" for f in _PAID], PAYMENT_START, "Payment_Id")


def flatten_payments(orders: DataFrame, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per payment with its number and key; orders without payments give none unless ``outer``."""
    return number_payments(unfold_payments(_ensure(orders, PAYMENT_START), [*keep, PAYMENT_START], outer), keep)


def payment_facts(orders: DataFrame, outer: bool = False) -> DataFrame:
    """The payment output. Payment amounts keep their sign."""
    return conform_payments(flatten_payments(orders, PAYMENT_HEADER_COLUMNS, outer))


def conform_payments(rows: DataFrame) -> DataFrame:
    """The payment output of numbered payments."""
    rows = rows.withColumns({"Payment_Date": short_date_text(F.col("Payment_Date")),
                             "Payment_Amount": amount(F.col("Payment_Amount"), negate=False)})
    return conform(rows, PAYMENT_RENAMES, PAYMENT_COLUMNS)


def with_payment_summary(orders: DataFrame) -> DataFrame:
    """Payment modes, gift-card flag and gift-card total per order, read from its own array."""
    payments = F.col(PAYMENTS)
    return orders.withColumns({"Payment_Mode": payment_modes(payments), "Gift_Card": has_gift_card(payments),
                               "Gift_Card_Amount": gift_card_amount(payments)})
