"""The daily run: raw orders and feed in, fact, personal and state tables out.

Each step returns DataFrames. ``run_day`` strings them together, writes the
outputs and registers the order keys last, so a run that fails can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow import contract as C
from orderflow.functions import amounts, codes, dates, nested, times
from orderflow.operators import channels, feed as feeds, lines, phones, privacy, quality, shape, state, timefill
from orderflow.operators.dedupe import dedupe_rare, dedupe_rows, key_conflicts, row_digest
from orderflow.operators.skew import repeated_keys
from orderflow.sources import readers, writers
from orderflow.sources.keyed import PARTS, KeyedTable, KeyRegister
from orderflow.sources.scratch import released, shuffles_dropped, staged

Stage = Callable[[DataFrame, str], DataFrame]


def keep(df: DataFrame, name: str) -> DataFrame:
    """A stage that writes nothing: the plan goes on as one."""
    return df


@dataclass
class Lookups:
    channels: DataFrame
    exceptions: DataFrame
    dimension: DataFrame
    stores: DataFrame
    blocklist: DataFrame | None = None


@dataclass
class Orders:
    """Orders of a run: one flat row each, the arrays of all complete orders by order key, and those set aside."""
    header: DataFrame
    arrays: DataFrame
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    missing_combinations: DataFrame | None = None
    conflicts: DataFrame | None = None


def dated_orders(raw: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Complete orders with a readable date and their keys, copies included, and the rejects."""
    complete, incomplete = quality.split_mandatory(raw, C.MANDATORY_ORDER_COLUMNS)
    dated = complete.withColumn("_day", dates.any_date(F.col("InvoiceDate")))
    unreadable = dated.filter(F.col("_day").isNull()).drop("_day") \
        .withColumn(quality.REASON, F.lit("bad_date:InvoiceDate"))
    good = dated.filter(F.col("_day").isNotNull()).withColumn("InvoiceDate", F.date_format("_day", dates.FLOW_FORMAT)).drop("_day")
    good = good.withColumns({
        "Header_Id": codes.header_id(F.col("OrderId"), F.col("InvoiceDate"), F.col("StoreCode")),
        "Orderwise_Id": codes.orderwise_id(F.col("TransactionNo"), F.col("PosTerminalNo"), F.col("StoreCode"),
                                           F.col("InvoiceDate"))})
    rejects = {"mandatory_missing": dedupe_rows(incomplete), "bad_date": dedupe_rows(unreadable)}
    return good, rejects


def repeated_orders(raw: DataFrame) -> DataFrame:
    """The ``repeated_keys`` of ``dated_orders``, for several that need them."""
    return repeated_keys(dated_orders(raw)[0], ["Header_Id"])


def keyed_orders(raw: DataFrame, repeated: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The orders of ``dated_orders``, one row per key, and the rejects; ``repeated`` may give ``repeated_orders``.

    Whole-row copies have equal keys, so the reduction to one row per key removes
    them as well and only rows of repeated keys are shuffled. Where different rows came
    under a key, one of them is taken; ``Orders.conflicts`` lists such keys.
    """
    good, rejects = dated_orders(raw)
    return dedupe_rare(good, ["Header_Id"], repeated=repeated, always=True), rejects


def raw_counts(raw: DataFrame, counts: quality.RunCounts) -> DataFrame:
    """Raw orders, counted as they are staged: all, those that lack a field, and those without a readable date."""
    missing = quality.any_missing(C.MANDATORY_ORDER_COLUMNS)
    return counts.watch(raw, input=None, mandatory_missing=missing, bad_date=~missing & dates.any_date(F.col("InvoiceDate")).isNull())


def matched_orders(orders: DataFrame, feed: DataFrame, days: int = C.FEED_WINDOW_DAYS,
                   trailing: bool = True) -> DataFrame:
    """Orders with their feed row and the channel and order type to be mapped."""
    matched = feeds.match_feed(feeds.with_web_order_number(orders), feed, days, trailing)
    return shape.first_known(matched, {"Enriched_Order_Type": ["Order Type", "OrderType"],
                                       "Enriched_Sales_Channel": ["New_Channel", "OrderSource"]})


def channelled_orders(matched: DataFrame, lookups: Lookups) -> DataFrame:
    mapped = channels.map_channels(matched, lookups.channels, lookups.dimension)
    return channels.override_channels(mapped, lookups.exceptions, lookups.dimension)


def with_amounts(df: DataFrame) -> DataFrame:
    cleaned = {c: amounts.amount(F.col(c)) for c in ("SGST", "CGST", "TotalOrderValue")}
    cleaned |= {c: amounts.amount(nested.first_scalar(df, c)) for c in ("NetAmount", "Totaldiscount")}
    cleaned["Totalorderqty"] = amounts.quantity(F.col("Totalorderqty"))
    return df.withColumns(cleaned).withColumn("Tax_Amount", amounts.tax(F.col("SGST"), F.col("CGST")))


def with_order_date(df: DataFrame) -> DataFrame:
    return df.withColumn("Enriched_Order_Date", dates.slashed(F.coalesce("Order_Date", "InvoiceDate")))


def with_dates(df: DataFrame, run_date: date) -> DataFrame:
    first = with_order_date(df).withColumns({
        "Business_Date": F.col("InvoiceDate"),
        "BillCloseddate": dates.short_date_text(F.col("BillCloseddate")),
        "System_Processed_Date": F.lit(f"{run_date:%Y/%m/%d}")})
    day = dates.flow_date(F.col("Enriched_Order_Date"))
    return first.withColumns({"Month": F.month(day), "Year": F.year(day), "Week_Day": dates.week_day(day),
                              "Week_Number": dates.week_number(day)})


def with_times(df: DataFrame) -> DataFrame:
    """The order's clock time as one format; the feed's order time comes before the till's."""
    till, feed_time = times.clock(F.col("InvoiceTime")), times.clock(shape.column("Order Time"))
    return df.withColumns({"InvoiceTime": till, "Enriched_Order_Time": F.coalesce(feed_time, till)})


def with_closing_time(df: DataFrame) -> DataFrame:
    return df.withColumn("BillClosetime", times.clock(F.col("BillClosetime")))


def flat_orders(orders: DataFrame) -> DataFrame:
    """Order rows without their arrays, with what the order output takes from them.

    The arrays are the bulk of an order. Reading them here, where they lie, keeps
    them out of every later shuffle of the header.
    """
    items = F.col(lines.ITEMS)
    flagged = orders.withColumns({"Non_Veg": nested.any_non_veg(items), "Deal": nested.any_with_promo(items),
                                  "Ala_Carte": nested.any_without_promo(items)})
    return lines.with_sizes(lines.with_payment_summary(flagged)).drop("ItemDetails", "PaymentsDetails")


def single_flat_orders(good: DataFrame, repeated: DataFrame) -> DataFrame:
    """Flat rows of ``dated_orders``, one per key: the row that ``keyed_orders`` takes, told by a digest of all of it.

    So that also where many keys repeat, what is sorted and shuffled has no arrays.
    """
    digests = dict(zip(("_first", "_second"), row_digest(good, [c for c in good.columns if c != "Header_Id"]), strict=True))
    flat = flat_orders(good.withColumns(digests))
    return dedupe_rare(flat, ["Header_Id"], [F.col(d) for d in digests], repeated=repeated).drop(*digests)


def with_flags(df: DataFrame) -> DataFrame:
    hour = times.hour(F.col("Enriched_Order_Time"))
    return df.withColumns({
        "Hour_Day_Part": hour, "Day_Part": times.day_part(hour),
        "Valid_Transaction": codes.valid_transaction(F.col("EntryStatus")),
        "Pizzahut_Brand": codes.prefix_label(shape.column("Pasta by PH"), C.BRAND_PREFIXES),
        "Enriched_Email_Id": F.coalesce(C.FEED_EMAIL, "Email")})


def timed_header(mapped: DataFrame, lookups: Lookups) -> DataFrame:
    """Mapped orders with what follows from other orders too: times, phones and line starts. Reads ``SHARED_COLUMNS`` and the feed's."""
    timed = timefill.fill_times(with_times(with_order_date(mapped)))
    phoned = phones.validate_phones(timed, lookups.blocklist, counted=mapped)
    return lines.with_line_starts(phoned, repeated_keys(mapped, lines.RECEIPT))


def final_header(timed: DataFrame, flat: DataFrame, lookups: Lookups, run_date: date) -> DataFrame:
    """Orders of ``timed_header`` with all their columns, numbers, dates, flags and stores."""
    plain = with_closing_time(with_dates(with_amounts(with_all_columns(timed, flat)), run_date))
    return channels.join_stores(with_flags(plain), lookups.stores)


#: What is read of an order where orders meet others: stored keys, the feed, store days, numbers, receipts.
SHARED_COLUMNS = ["Header_Id", "OrderId", "StoreCode", "WeborderNo", "InvoiceDate", "InvoiceTime", "OrderSource", "OrderType", "PhoneNo",
                  lines.ITEM_COUNT, lines.PAYMENT_COUNT]


def with_all_columns(orders: DataFrame, flat: DataFrame) -> DataFrame:
    """Orders that went on with ``SHARED_COLUMNS``, with the other columns of ``flat``: one join by a key that is unique on both sides.

    Of the other columns, only those that are read in the end are shuffled.
    """
    return orders.join(flat.drop(*[c for c in SHARED_COLUMNS if c != "Header_Id"]), "Header_Id")


_STORED = "_stored"


def build_orders(raw: DataFrame, feed: DataFrame, processed: DataFrame, lookups: Lookups, run_date: date,
                 days: int = C.FEED_WINDOW_DAYS, trailing: bool = True, stage: Stage = keep,
                 counts: quality.RunCounts | None = None, repeated: DataFrame | None = None, last: Stage | None = None) -> Orders:
    """From raw orders to the final header.

    ``stage`` decides whether the points that several readers share are written
    (``staged``) or left as one plan (``keep``), and ``last`` the same for the final header, where it differs: left as a plan, a single
    reader moves only the columns that it reads. ``counts`` takes the rows of each step
    as they are written, so it needs a stage that writes. ``repeated`` may give the ``repeated_orders`` of ``raw``.

    Flat orders are written once, where they are built. Only ``SHARED_COLUMNS`` of them go through the steps in which orders
    meet others; the final header takes the rest from the written table.
    """
    watch = counts.watch if counts else lambda df, **_: df
    good, rejects = dated_orders(raw)
    repeated = repeated_keys(good, ["Header_Id"]) if repeated is None else repeated
    flat = stage(watch(single_flat_orders(good, repeated), keys=None), "flat-orders")
    flagged = watch(state.flagged_orders(flat.select(*SHARED_COLUMNS), processed, _STORED), already_stored=F.col(_STORED))
    fresh = stage(flagged.filter(~F.col(_STORED)).drop(_STORED), "new-orders")
    web, match = F.col("Enriched_WebOrder_No").isNotNull(), F.col(feeds.MATCH)
    mapped = watch(channelled_orders(matched_orders(fresh, feed, days, trailing), lookups),
                   same_day=match == feeds.SAME_DAY, other_day=match == feeds.OTHER_DAY, unmatched=web & match.isNull(),
                   no_web_number=~web, unmapped=channels.is_unmapped())
    mapped = stage(mapped, "mapped-orders")
    kept, unmapped = channels.split_unmapped(mapped)
    rejects["unmapped_channel"] = with_all_columns(unmapped, flat)
    header = final_header(stage(timed_header(kept, lookups), "timed-orders"), flat, lookups, run_date)
    arrays = dedupe_rare(good, ["Header_Id"], repeated=repeated).select("Header_Id", "ItemDetails", "PaymentsDetails")
    return Orders((last or stage)(header, "final-header"), arrays, rejects, channels.missing_combinations(mapped),
                  key_conflicts(good, ["Header_Id"]))


def _dated(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: dates.output_date_text(F.col(c)) for c in columns})


def baseline_facts(orders: Orders) -> DataFrame:
    """The order output: the contract columns and two placeholders."""
    rows = shape.conform(orders.header, C.HEADER_RENAMES, C.BASELINE_COLUMNS)
    rows = rows.withColumn("Franchise", codes.upper_or(F.col("Franchise"), C.DEFAULT_FRANCHISE))
    return _dated(shape.add_placeholders(rows, C.BASELINE_PLACEHOLDERS), C.BASELINE_DATE_COLUMNS)


def line_facts(orders: Orders) -> DataFrame:
    """The line output. Arrays are unfolded where they lie, so that only fields that are read meet the header."""
    header = shape.copy_column(orders.header, "Franchise", "Store_Franchise")
    header = header.select(*C.LINE_HEADER_COLUMNS, lines.ITEM_START)
    items = lines.unfold_items(orders.arrays, ["Header_Id"]).join(header, "Header_Id")
    rows = lines.conform_lines(lines.number_items(items, C.LINE_HEADER_COLUMNS))
    return _dated(shape.add_placeholders(rows, C.LINE_PLACEHOLDERS), C.LINE_DATE_COLUMNS)


def payment_facts(orders: Orders) -> DataFrame:
    """The payment output, joined like the lines."""
    header = orders.header.select(*C.PAYMENT_HEADER_COLUMNS, lines.PAYMENT_START)
    payments = lines.unfold_payments(orders.arrays, ["Header_Id"]).join(header, "Header_Id")
    rows = lines.conform_payments(lines.number_payments(payments, C.PAYMENT_HEADER_COLUMNS))
    return _dated(shape.add_placeholders(rows, C.PAYMENT_PLACEHOLDERS), C.PAYMENT_DATE_COLUMNS)


def personal_rows(header: DataFrame, key: str, iv: str) -> DataFrame:
    """Order rows with personal columns encrypted, for the customer and order-PII tables."""
    rows = shape.add_placeholders(shape.conform(header, C.HEADER_RENAMES, C.PII_HEADER_COLUMNS), ["Address"])
    rows = shape.rename(rows.withColumn("Franchise", codes.upper_or(F.col("Franchise"), C.DEFAULT_FRANCHISE)),
                        C.PII_RENAMES)
    rows = rows.withColumns({"Order_Date": dates.output_date_text(F.col("Order_Date")),
                             "Unsubscribed": F.lit(False), "Unsubscribe_Date": F.lit("")})
    return privacy.protect(rows, C.PII_ENCRYPTED_COLUMNS, key, iv)


def order_pii_rows(personal: DataFrame) -> DataFrame:
    """Order-PII rows under their state names."""
    rows = personal.withColumnRenamed(privacy.ENCRYPTED_MOBILE, "Mobile_Number").select(*C.PII_COLUMNS)
    return shape.fill_text(shape.rename(dedupe_rare(rows, ["Header_Id"]), C.PII_STATE_RENAMES))


def customer_rows(personal: DataFrame, with_missing_phone: bool = True, missing: str = "") -> DataFrame:
    """Customer rows of a run; orders without a number share one customer unless left out.

    ``missing`` is the encrypted stand-in for a missing number, to leave it out.
    """
    rows = personal.select(*C.CUSTOMER_DELTA_COLUMNS, "Order_Time", "Header_Id")
    return rows if with_missing_phone else rows.filter(F.col(privacy.ENCRYPTED_MOBILE) != missing)


def mapping_rows(header: DataFrame, key: str, iv: str) -> DataFrame:
    rows = shape.conform(header, C.HEADER_RENAMES, C.MAPPING_HEADER_COLUMNS)
    rows = rows.withColumn("Franchise", codes.upper_or(F.col("Franchise"), C.DEFAULT_FRANCHISE))
    return state.mapping_rows(rows, key, iv)


HEADER_IDS = T.StructType([T.StructField("Header_Id", T.StringType())])

#: What a run counts of its input. All but the first and the last add up to the first.
INPUT_STAGES = ["input", "mandatory_missing", "bad_date", "copies", "already_stored", "same_day", "other_day", "unmatched", "no_web_number", "unmapped"]


def step_counts(counts: quality.RunCounts) -> None:
    """Adds what follows from the counts of the steps: rows that repeat the key of another."""
    found = counts.rows()
    counts.put(copies=found["input"] - found["mandatory_missing"] - found["bad_date"] - found["keys"])


def state_tables(spark: SparkSession, state_root: str, pii: T.StructType, parts: int = PARTS) -> dict[str, KeyedTable]:
    """The state tables under ``state_root``, in parts by key."""
    root = state_root.rstrip("/")
    return {"customers": KeyedTable(spark, f"{root}/customers", "Mobile_Number", C.CUSTOMER_STATE_SCHEMA, parts),
            "order_pii": KeyedTable(spark, f"{root}/order_pii", "Header_Id", pii, parts),
            "mapping": KeyedTable(spark, f"{root}/mapping", "Header_Id", C.MAPPING_STATE_SCHEMA, parts)}


def processed_register(spark: SparkSession, state_root: str) -> KeyRegister:
    """The order keys that runs have stored, by invoice day."""
    return KeyRegister(spark, f"{state_root.rstrip('/')}/processed", "Header_Id", "invoice_day")


def _invoice_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("invoice_day", dates.output_date_text(dates.any_date_text(F.col("InvoiceDate"))))


def run_day(spark: SparkSession, raw: DataFrame, feed: DataFrame | str, lookups: Lookups, run_date: date, output: str,
            state_root: str, key: str, iv: str, trailing: bool = True, parts: int = PARTS) -> DataFrame:
    """One daily run. Returns its row counts: the steps of ``INPUT_STAGES`` and each output.

    ``feed`` is a table of feed rows, or the root of day folders, of which those that the
    orders' days look at are read. Facts go to a folder of the run under ``output``, which
    a repeated run replaces. State tables lie under ``state_root`` in parts by key; the
    run reads the parts that its keys fall into as they were before ``run_date`` and
    writes them to a folder of its own, so a run that fails or is repeated leaves the
    state before it as it was, and its own snapshot never counts as the state before it.
    Order keys are registered last. Days are to be run in order (``catch_up``). Working
    tables are deleted at the end, also after a failure.
    """
    run, counts = readers.day_folder(output, run_date), quality.RunCounts()
    with released(spark), shuffles_dropped(spark):
        staged_raw = staged(raw_counts(raw, counts), "raw-orders")
        if isinstance(feed, str):
            read = staged_raw.select(dates.any_date_text(F.col("InvoiceDate")).alias("InvoiceDate"))
            feed = readers.read_feed(spark, feed, feeds.feed_days(read, trailing=trailing))
        register = processed_register(spark, state_root)
        processed = register.read(_invoice_day(staged_raw).select("invoice_day"), run_date)
        orders = build_orders(staged_raw, feed, processed, lookups, run_date, trailing=trailing, stage=staged, counts=counts)
        header = orders.header
        for reason, rows in orders.rejects.items():
            writers.write_rejects(counts.watch(rows, **{f"rejects_{reason}": None}), f"{run}/REJECTS/{reason}")
        writers.write_keys(orders.missing_combinations, f"{run}/REJECTS/missing_combinations")
        writers.write_rejects(counts.watch(orders.conflicts, key_conflicts=None), f"{run}/REJECTS/key_conflicts", "different_rows")
        facts = {"baseline": (baseline_facts(orders), "Enriched_Order_Date"),
                 "line": (line_facts(orders), "Invoice_Open_Date"),
                 "payment": (payment_facts(orders), "Invoice_Open_Date")}
        for name, (rows, day) in facts.items():
            writers.write_facts(rows, f"{run}/{name.upper()}", day, watch=lambda df, name=name: counts.watch(df, **{name: None}))

        personal = staged(personal_rows(header, key, iv), "personal-rows")
        pii = staged(order_pii_rows(personal), "order-pii")
        mapping = staged(mapping_rows(header, key, iv), "mapping-rows")
        customers = staged(customer_rows(personal), "customer-rows")
        fold_customers = lambda old, new: state.merge_customers(old, new, touched_only=False, tie_break=["Order_Time", "Header_Id"])
        merges = {"customers": (customers, fold_customers, privacy.ENCRYPTED_MOBILE), "order_pii": (pii, state.merge_order_pii, None),
                  "mapping": (mapping, state.merge_mapping, None)}
        tables = state_tables(spark, state_root, pii.schema, parts)
        for name, (rows, fold, own) in merges.items():
            touched = tables[name].merge(rows, fold, run_date, own, lambda df, name=name: counts.watch(df, **{name: None}))
            counts.put(**{f"{name}_parts": len(touched)})
        register.append(_invoice_day(header), run_date, lambda df: counts.watch(df, processed=None))
        step_counts(counts)
        found = counts.rows()
    return spark.createDataFrame([(s, found[s]) for s in [*INPUT_STAGES, *[n for n in found if n not in (*INPUT_STAGES, "keys")]]],
                                 "stage string, row_count long")
