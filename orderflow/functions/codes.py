"""Order numbers, composite keys and small label rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from orderflow.functions.dates import compact


def web_order_number(text: Column) -> Column:
    """Drops a trailing ``P``/``p``, else the trailing ``0`` of a nine-character number."""
    shorter = F.substr(text, F.lit(1), F.length(text) - 1)
    return (F.when(F.right(text, F.lit(1)).isin("P", "p"), shorter)
            .when((F.length(text) == 9) & text.endswith("0"), shorter)
            .otherwise(text))


def header_id(order_id: Column, invoice_date: Column, store: Column) -> Column:
    """Order key ``order_yyyymmdd_store``; missing parts are left out."""
    return F.concat_ws("_", order_id, compact(invoice_date), store)


def orderwise_id(transaction: Column, terminal: Column, store: Column, invoice_date: Column) -> Column:
    """Till key ``transaction_terminal_store_yyyymmdd``; missing parts are left out."""
    return F.concat_ws("_", transaction, terminal, store, compact(invoice_date))


def prefix_label(text: Column, labels: Mapping[str, str]) -> Column:
    """The label of the first prefix that fits, else the text itself."""
    chain = F
    for prefix, label in labels.items():
        chain = chain.when(text.startswith(prefix), F.lit(label))
    return chain.otherwise(text)


def valid_transaction(entry_status: Column) -> Column:
    """False for voided entries, true for all others and for none."""
    return ~entry_status.eqNullSafe(F.lit("Voided"))


def item_base(category: Column, group: Column) -> Column:
    """Product group of pizzas and food, null for every other category."""
    return F.when(F.lower(category).isin("pizza", "food"), group)


def upper_or(text: Column, default: str) -> Column:
    """Upper-case text with a default for null."""
    return F.coalesce(F.upper(text), F.lit(default))


def blank_to(text: Column, filler: str) -> Column:
    """Replaces null and blank text."""
    return F.when(text.isNull() | (F.trim(text) == ""), F.lit(filler)).otherwise(text)
