"""Queries of filters, null handling, projections, duplicates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow import contract as C
from orderflow.catalog.fixtures import Inputs
from orderflow.catalog.registry import query
from orderflow.functions import codes, dates, nested
from orderflow.operators import dedupe, feed, quality, shape, state
from orderflow.plans import daily
from orderflow.sources.scratch import staged

_TEXT = ["OrderId", "TransactionNo", "StoreCode", "TotalOrderValue", "Totalorderqty", "WeborderNo"]


@query("q_mandatory_clean", f"""
select {', '.join(_TEXT)} from raw_orders where TotalOrderValue is not null and Totalorderqty is not null""")
def mandatory_clean(x: Inputs) -> DataFrame:
    return quality.split_mandatory(x.headers, C.MANDATORY_ORDER_COLUMNS)[0].select(*_TEXT)


@query("q_mandatory_rejects", """
select OrderId, 'missing:' || concat_ws(',', case when Totalorderqty is null then 'Totalorderqty' end,
 case when TotalOrderValue is null then 'TotalOrderValue' end) reject_reason
from raw_orders where TotalOrderValue is null or Totalorderqty is null""")
def mandatory_rejects(x: Inputs) -> DataFrame:
    return quality.split_mandatory(x.headers, C.MANDATORY_ORDER_COLUMNS)[1].select("OrderId", quality.REASON)


_PROFILED = ["PosTerminalNo", "InvoiceTime", "WeborderNo", "PhoneNo", "Email", "OrderId"]


@query("q_null_profile", " union all ".join(
    f"select '{c}' column_name, count(*) filter (where {c} is null) null_count from raw_orders" for c in _PROFILED))
def null_profile(x: Inputs) -> DataFrame:
    return quality.null_profile(x.headers, _PROFILED)


@query("q_null_split_counts", """
select 'web' part, count(*) row_count from raw_orders where WeborderNo is not null
union all select 'till', count(*) from raw_orders where WeborderNo is null""")
def null_split_counts(x: Inputs) -> DataFrame:
    web, till = shape.split_null(x.headers, "WeborderNo")
    return quality.run_report({"web": web, "till": till}).withColumnRenamed("stage", "part")


@query("q_fill_defaults", """
select o_orderkey, coalesce(PhoneNo, 'xxxxxxxxxx') PhoneNo, coalesce(Email, 'none') Email, OrderType from raw_orders""")
def fill_defaults(x: Inputs) -> DataFrame:
    rows = shape.fill_defaults(x.headers, {"PhoneNo": C.MISSING_PHONE, "Email": "none"})
    return rows.select("o_orderkey", "PhoneNo", "Email", "OrderType")


@query("q_fill_text", """
select o_orderkey, coalesce(PhoneNo, '') PhoneNo, coalesce(Email, '') Email, n_items from raw_orders""")
def fill_text(x: Inputs) -> DataFrame:
    return shape.fill_text(x.headers.select("o_orderkey", "PhoneNo", "Email", "n_items"))


@query("q_coalesce_pairs", """
select o_orderkey, coalesce(OrderSource, OrderType) kind, coalesce(Email, PhoneNo, 'none') contact,
 coalesce(InvoiceTime, BillClosetime) clock from raw_orders""")
def coalesce_pairs(x: Inputs) -> DataFrame:
    rows = shape.first_known(x.headers.withColumn("none", F.lit("none")), {
        "kind": ["OrderSource", "OrderType"], "contact": ["Email", "PhoneNo", "none"],
        "clock": ["InvoiceTime", "BillClosetime"]})
    return rows.select("o_orderkey", "kind", "contact", "clock")


@query("q_blank_placeholder", """
select OrderNo, Order_Date, case when Aggregator_Order_ID is null or trim(Aggregator_Order_ID) = '' then '  '
 else Aggregator_Order_ID end aggregator_id from all_feed""")
def blank_placeholder(x: Inputs) -> DataFrame:
    return x.feed.select("OrderNo", "Order_Date",
                         codes.blank_to(shape.column("Aggregator Order ID"), "  ").alias("aggregator_id"))


_SHORT = {"OrderId": "Receipt_No", "TransactionNo": "Transaction_No", "StoreCode": "Store_No", "City": "Store_City",
          "EntryStatus": "Entry_Status", "PosTerminalNo": "POS_Terminal_No", "CustomerName": "Customer_Name"}


@query("q_conform_baseline", "select " + ", ".join(f"{a} as {b}" for a, b in _SHORT.items()) + " from raw_orders")
def conform_baseline(x: Inputs) -> DataFrame:
    return shape.conform(x.headers, C.HEADER_RENAMES, list(_SHORT.values()))


_MAPPED = {"OrderNo": "Online_ref_ID", "Store_Code": "Store_No", "Aggregator_Order_ID": "Aggregator_Id",
           "Reference_No": "Reference_No", "Pasta_by_PH": "Pizzahut_Brand", "feed_day": "feed_day"}


@query("q_conform_mapping", "select " + ", ".join(f"{a} as {b}" for a, b in _MAPPED.items())
       + " from (select *, feed_date::varchar feed_day from all_feed) f")
def conform_mapping(x: Inputs) -> DataFrame:
    names = {a.replace("_", " ") if a != "OrderNo" else a: b for a, b in _MAPPED.items() if a != "feed_day"}
    rows = x.feed.withColumn("feed_day", F.col("feed_date").cast("string"))
    return shape.conform(rows, names, list(_MAPPED.values()))


@query("q_placeholders", """
select o_orderkey, cast(null as varchar) GES_Code, cast(null as varchar) Transaction_Type,
 cast(null as varchar) Empty_Column_1, cast(null as varchar) Empty_Column_2, false Unsubscribed, '' Unsubscribe_Date,
 StoreCode Store_Copy from orders join (select o_orderkey ok, StoreCode from raw_orders) r on ok = o_orderkey""")
def placeholders(x: Inputs) -> DataFrame:
    rows = shape.add_placeholders(x.headers.select("o_orderkey", "StoreCode"), C.BASELINE_PLACEHOLDERS)
    rows = shape.add_empty_columns(rows, 2).withColumns({"Unsubscribed": F.lit(False), "Unsubscribe_Date": F.lit("")})
    return shape.copy_column(rows, "StoreCode", "Store_Copy").drop("StoreCode")


@query("q_copy_column", "select o_orderkey, InvoiceDate, InvoiceDate Business_Date, StoreCode Store_Franchise from raw_orders")
def copy_column(x: Inputs) -> DataFrame:
    rows = shape.copy_column(x.headers, "InvoiceDate", "Business_Date")
    return shape.copy_column(rows, "StoreCode", "Store_Franchise").select(
        "o_orderkey", "InvoiceDate", "Business_Date", "Store_Franchise")


@query("q_rename_old", "select o_orderkey, OrderSource Old_OrderSource, OrderType Old_OrderType from raw_orders")
def rename_old(x: Inputs) -> DataFrame:
    return shape.rename_old(x.headers.select("o_orderkey", "OrderSource", "OrderType"), ["OrderSource", "OrderType"])


@query("q_first_scalar", """
select o_orderkey, NetAmount plain, case when n_items > 0 then NetAmount end from_array, Totaldiscount from_struct,
 cast(null as varchar) untyped from raw_orders""")
def first_scalar(x: Inputs) -> DataFrame:
    rows = x.headers.select("o_orderkey", F.col("NetAmount").alias("plain"),
                            F.when(F.col("n_items") > 0, F.array("NetAmount", "SGST")).otherwise(F.array())
                            .alias("from_array"),
                            F.struct("Totaldiscount", "CGST").alias("from_struct"), F.lit(None).alias("untyped"))
    picked = {c: nested.first_scalar(rows, c) for c in ("plain", "from_array", "from_struct")}
    return shape.untyped_to_text(rows.withColumns(picked))


@query("q_struct_expand", "select o_orderkey, City, StoreName from raw_orders")
def struct_expand(x: Inputs) -> DataFrame:
    return shape.expand_struct(x.headers.select("o_orderkey", F.struct("City", "StoreName").alias("store")), "store")


@query("q_array_first", """
select OrderId, max(case when i = 1 then it_ItemNo end) first_item, max(case when i = 2 then it_ItemNo end) second_item
from (select h.OrderId, a.i, a.it_ItemNo from raw_orders h left join all_items a using (o_orderkey)) x group by OrderId""")
def array_first(x: Inputs) -> DataFrame:
    number = lambda at: F.try_element_at(F.col("ItemDetails.Items"), F.lit(at))["ItemNo"]
    return x.orders.select("OrderId", number(1).alias("first_item"), number(2).alias("second_item"))


@query("q_equality_filter", "select OrderNo, Order_Date, Store_Code from all_feed where Franchise = 'dil' and Order_Type = 'Delivery'")
def equality_filter(x: Inputs) -> DataFrame:
    return x.own_feed.filter(shape.column("Order Type") == "Delivery").select(
        "OrderNo", "Order_Date", shape.column("Store Code").alias("Store_Code"))


@query("q_distinct_values", "select distinct StoreCode, EntryStatus from raw_orders")
def distinct_values(x: Inputs) -> DataFrame:
    return dedupe.distinct_values(x.headers, "StoreCode", "EntryStatus")


@query("q_dedupe_whole_row", "select distinct l_orderkey, l_suppkey, l_returnflag from lineitem")
def dedupe_whole_row(x: Inputs) -> DataFrame:
    return dedupe.dedupe_rows(x.table("lineitem").select("l_orderkey", "l_suppkey", "l_returnflag"))


_ITEM_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity"


@query("q_first_per_key", f"""
select l_orderkey, l_shipdate::varchar ship_day, {_ITEM_ORDER} from (
 select *, row_number() over (partition by l_orderkey order by l_shipdate desc, {_ITEM_ORDER}) n from lineitem) x where n = 1""")
def first_per_key(x: Inputs) -> DataFrame:
    rows = x.table("lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    first = dedupe.dedupe_by(rows, ["l_orderkey"], [F.col("l_shipdate").desc(), *_ITEM_ORDER.split(", ")])
    return first.withColumn("ship_day", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).drop("l_shipdate")


@query("q_last_value", "select strftime(max(cast(o_orderdate as date)), '%Y/%m/%d') last_load_date from orders")
def last_value(x: Inputs) -> DataFrame:
    return x.table("orders").agg(F.date_format(F.max(F.col("o_orderdate").cast("date")), dates.FLOW_FORMAT)
                                 .alias("last_load_date"))


@query("q_key_difference", """
select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def key_difference(x: Inputs) -> DataFrame:
    returned = x.table("lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.without_keys(x.table("orders").select("o_orderkey", "o_custkey"), returned, ["o_orderkey"])


@query("q_recombine", """
select h.Header_Id, h.WeborderNo, m.Order_Time feed_time, m.match_class from fresh_orders h
left join trailing_matches m on m.hkey = h.o_orderkey""")
def recombine(x: Inputs) -> DataFrame:
    matched = staged(daily.matched_orders(fresh_orders(x, "OrderSource", "OrderType"), x.own_feed), "matched-orders")
    hit, miss, till = feed.split_match(matched)
    parts = [hit, miss.drop("Order Time", feed.MATCH), till.drop("Order Time", feed.MATCH)]
    return feed.recombine(parts).select("Header_Id", "WeborderNo", shape.column("Order Time").alias("feed_time"),
                                        feed.MATCH)


def complete_orders(x: Inputs, nested_rows: bool = True) -> DataFrame:
    """Complete orders of the inputs with keys; without their arrays where a query does not read them."""
    return daily.keyed_orders(x.orders if nested_rows else x.headers)[0]


def stored_orders(complete: DataFrame) -> DataFrame:
    """Every tenth order, taken as stored by an earlier run."""
    return complete.filter(F.col("OrderId").cast("bigint") % 10 == 0).select("Header_Id")


#: What matching reads of an order; every stored order is told by its ``OrderId``.
MATCH_COLUMNS = ["Header_Id", "OrderId", "StoreCode", "WeborderNo", "InvoiceDate"]


def fresh_orders(x: Inputs, *more: str) -> DataFrame:
    """Complete orders that are not stored yet, with ``MATCH_COLUMNS`` and ``more``.

    Orders are built once and written with the columns that the query reads, so that only these are shuffled against the
    stored keys. The result is written as well because matching reads it more than once.
    """
    good = daily.dated_orders(x.headers)[0]
    kept = staged(good.select(*MATCH_COLUMNS, *more), "dated-orders")
    complete = dedupe.dedupe_rare(good, ["Header_Id"], kept=kept)
    return staged(state.new_orders(complete, stored_orders(complete)), "fresh-orders")
