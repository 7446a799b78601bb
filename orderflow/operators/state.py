"""Tables that carry over from run to run, as snapshots merged with the rows of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.contract import CUSTOMER_STATE_SCHEMA, MAPPING_RENAMES, MAPPING_STATE_SCHEMA
from orderflow.functions.codes import blank_to
from orderflow.functions.dates import output_date_text, state_date, state_date_text
from orderflow.functions.privacy import encrypt, stable_id
from orderflow.operators.dedupe import dedupe_by, with_keys, without_keys
from orderflow.operators.shape import conform, fill_text

_NEW, _AT = "_new", "_at"


def new_orders(orders: DataFrame, processed: DataFrame, key: str = "Header_Id") -> DataFrame:
    """Orders, one row per key, whose key no earlier run has stored."""
    return without_keys(orders, processed, [key])


def flagged_orders(orders: DataFrame, processed: DataFrame, flag: str, key: str = "Header_Id") -> DataFrame:
    """Orders, one row per key, with whether an earlier run has stored their key."""
    stored = processed.select(key).distinct().withColumn(flag, F.lit(True))
    return orders.join(stored, key, "left").withColumn(flag, F.col(flag).isNotNull())


def seen_orders(orders: DataFrame, processed: DataFrame, key: str = "Header_Id") -> DataFrame:
    """Orders, one row per key, whose key an earlier run has stored."""
    return with_keys(orders, processed, [key])


def availability(ids: DataFrame, processed: DataFrame, key: str = "Header_Id") -> DataFrame:
    """Each distinct key with ``yes`` when it is stored, else ``no``."""
    stored = processed.select(key).distinct().withColumn("available", F.lit("yes"))
    return ids.select(key).distinct().join(stored, key, "left").na.fill({"available": "no"})


def register(processed: DataFrame, orders: DataFrame, key: str = "Header_Id") -> DataFrame:
    """The stored keys together with those of a run."""
    return processed.select(key).unionByName(orders.select(key)).distinct()


def existing_rows(state: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """State rows, one per key, for the keys of a run."""
    return with_keys(state, rows, [key])


def _at(run: int, day: Column, ties: Sequence[Column]) -> Column:
    return F.struct(F.lit(run).alias("run"), day.alias("day"),
                    *[t.alias(f"tie_{i}") for i, t in enumerate(ties)]).alias(_AT)


def merge_customers(state: DataFrame, orders: DataFrame, valid_rule: str = "newest",
                    touched_only: bool = True, tie_break: Sequence[str] = ()) -> DataFrame:
    """Customer state with a run's orders folded in.

    First and last order day widen, flags come from the newest order, the id stays
    that of first sight. All of it is one aggregate by number that sums up before
    the shuffle, so a number shared by very many orders is no bottleneck.
    ``valid_rule='any'`` keeps a number valid once any order had it valid.
    """
    if valid_rule not in ("newest", "any"):
        raise ValueError("valid_rule is 'newest' or 'any'")
    old = state.select(
        "Mobile_Number", "Customer_Id", state_date(F.col("First_Order_Date")).alias("First_Order_Date"),
        state_date(F.col("Last_Order_Date")).alias("Last_Order_Date"), "Valid", "Unsubscribed", "Unsubscribe_Date",
        F.lit(False).alias(_NEW), _at(0, state_date(F.col("Last_Order_Date")), [F.lit("") for _ in tie_break]))
    day = state_date(F.col("Order_Date"))
    new = orders.select(
        F.col("Encrypted_Mobile_Number").alias("Mobile_Number"), "Customer_Id", day.alias("First_Order_Date"),
        day.alias("Last_Order_Date"), "Valid", "Unsubscribed", "Unsubscribe_Date", F.lit(True).alias(_NEW),
        _at(1, day, [F.coalesce(F.col(c), F.lit("")) for c in tie_break]))
    newest = lambda name: F.max_by(name, F.col("_newest"))
    rows = old.union(new).withColumn("_newest", F.struct(_AT, "Valid", "Unsubscribed", "Unsubscribe_Date"))
    valid = newest("Valid") if valid_rule == "newest" else F.bool_or("Valid")
    merged = rows.groupBy("Mobile_Number").agg(
        F.min_by("Customer_Id", F.struct(_AT, "Customer_Id")).alias("Customer_Id"),
        state_date_text(F.min("First_Order_Date")).alias("First_Order_Date"),
        state_date_text(F.max("Last_Order_Date")).alias("Last_Order_Date"),
        valid.alias("Valid"), newest("Unsubscribed").alias("Unsubscribed"),
        F.coalesce(newest("Unsubscribe_Date"), F.lit("")).alias("Unsubscribe_Date"), F.bool_or(_NEW).alias(_NEW))
    if touched_only:
        merged = merged.filter(F.col(_NEW))
    return merged.select(*CUSTOMER_STATE_SCHEMA.fieldNames())


def replace_rows(state: DataFrame, rows: DataFrame, key: str, order: Sequence[Column] = (),
                 touched_only: bool = False) -> DataFrame:
    """Snapshot in which a run's row replaces the stored row of the same key."""
    both = state.withColumn(_NEW, F.lit(False)).unionByName(rows.withColumn(_NEW, F.lit(True)))
    latest = dedupe_by(both, [key], [F.col(_NEW).desc(), *order])
    return (latest.filter(F.col(_NEW)) if touched_only else latest).drop(_NEW)


def mapping_rows(orders: DataFrame, key: str, iv: str) -> DataFrame:
    """Id-mapping rows of a run: customer id instead of the number, contract names."""
    sealed = orders.withColumns({
        "Enriched_Order_Date": output_date_text(F.col("Enriched_Order_Date").cast("string")),
        "Customer_Id": stable_id(encrypt(F.col("Mobile_Number"), key, iv))})
    rows = conform(sealed, MAPPING_RENAMES, MAPPING_STATE_SCHEMA.fieldNames())
    return rows.withColumn("Aggregator_Id", blank_to(F.col("Aggregator_Id"), "  "))


def merge_mapping(state: DataFrame, rows: DataFrame, touched_only: bool = False) -> DataFrame:
    """Id-mapping snapshot: a run's row replaces the stored one, nulls become ``''``."""
    return fill_text(replace_rows(state, rows, "Header_Id", touched_only=touched_only))


def merge_order_pii(state: DataFrame, rows: DataFrame, touched_only: bool = False) -> DataFrame:
    """Order-PII snapshot: one row per order, a run's row replaces the stored one."""
    return fill_text(replace_rows(state, rows, "Header_Id", touched_only=touched_only))
