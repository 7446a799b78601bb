"""Queries of the scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.catalog import checks as K
from orderflow.catalog.fixtures import Inputs, cents, clock12, clock24, money, two
from orderflow.catalog.registry import query, table
from orderflow.contract import BRAND_PREFIXES
from orderflow.functions import amounts, codes, dates, times
from orderflow.operators import shape
from orderflow.operators.channels import match_text, shown_text

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_ODD = "when l_partkey % 23 = 0 then '' when l_partkey % 29 = 0 then 'abc' when l_partkey % 31 = 0 then null"

AMOUNT_TEXTS = f"""
select {_LINE}, l_quantity, case {_ODD} when l_suppkey % 9 = 0 then '0' else {money(cents('l_extendedprice'))} end amount_text,
 case when l_partkey % 13 = 0 then null else {money(cents('l_extendedprice * l_tax'))} end sgst_text,
 {money(cents('l_extendedprice * l_tax'))} cgst_text,
 case {_ODD} when l_linenumber % 2 = 0 then concat('-', cast(cast(l_quantity as int) as string), '.00')
   when l_linenumber = 1 then concat('-1,', lpad(cast(cast(l_quantity as int) as string), 3, '0'))
   else cast(cast(l_quantity as int) as string) end quantity_text
from {{lineitem}}"""
table("amount_texts", K.plain(AMOUNT_TEXTS))


@query("q_amount_clean", f"""
select {_LINE}, {K.number('amount_text')} sale_amount, {K.number('amount_text', False)} paid_amount from amount_texts""")
def amount_clean(x: Inputs) -> DataFrame:
    t = F.col("amount_text")
    return x.sql(AMOUNT_TEXTS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      amounts.amount(t).alias("sale_amount"),
                                      amounts.amount(t, negate=False).alias("paid_amount"))


@query("q_quantity_clean", f"select {_LINE}, {K.whole('quantity_text')} quantity from amount_texts")
def quantity_clean(x: Inputs) -> DataFrame:
    return x.sql(AMOUNT_TEXTS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      amounts.quantity(F.col("quantity_text")).alias("quantity"))


@query("q_tax_sum", f"""
select {_LINE}, {K.number('sgst_text')} + {K.number('cgst_text')} tax_amount from amount_texts""")
def tax_sum(x: Inputs) -> DataFrame:
    tax = amounts.tax(amounts.amount(F.col("sgst_text")), amounts.amount(F.col("cgst_text")))
    return x.sql(AMOUNT_TEXTS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", tax.alias("tax_amount"))


_D, _M, _Y = two("day(l_shipdate)"), two("month(l_shipdate)"), "cast(year(l_shipdate) as string)"
_SHORT_D, _SHORT_M = "cast(day(l_shipdate) as string)", "cast(month(l_shipdate) as string)"
DATE_TEXTS = f"""
select {_LINE}, case l_partkey % 10 when 0 then concat({_D}, '-', {_M}, '-', substr({_Y}, 3, 2))
 when 1 then concat({_SHORT_D}, '-', {_SHORT_M}, '-', {_Y}) when 2 then concat({_M}, '/', {_D}, '/', substr({_Y}, 3, 2))
 when 3 then concat({_SHORT_M}, '/', {_SHORT_D}, '/', {_Y}) when 4 then concat({_Y}, '-', {_M}, '-', {_D})
 when 5 then concat({_Y}, '/', {_M}, '/', {_D}) when 6 then concat('31-13-', {_Y}) when 7 then ''
 when 8 then null else concat({_M}, '/', {_D}, '/75') end date_text,
 case when l_suppkey % 7 = 0 then 'x' when l_suppkey % 8 = 0 then null
   else concat({_M}, '/', {_D}, '/', substr({_Y}, 3, 2)) end short_text,
 case when l_suppkey % 5 = 0 then null else concat({_Y}, '/', {_M}, '/', {_D}) end flow_text,
 concat({_Y}, '-', {_M}, '-', {_D}) dash_text
from {{lineitem}}"""
table("date_texts", K.plain(DATE_TEXTS))


@query("q_date_multiformat", f"""
select {_LINE}, strftime({K.any_date('date_text')}, '%Y/%m/%d') order_date from date_texts""")
def date_multiformat(x: Inputs) -> DataFrame:
    return x.sql(DATE_TEXTS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    dates.any_date_text(F.col("date_text")).alias("order_date"))


@query("q_date_reformat", f"""
select {_LINE}, strftime(try_strptime(regexp_replace(short_text, '/([0-9]{{2}})$', '/20\\1'), '%m/%d/%Y'), '%Y/%m/%d') closed_date,
 replace(flow_text, '/', '-') output_date, replace(dash_text, '-', '/') slashed_date,
 replace(flow_text, '/', '') compact_date from date_texts""")
def date_reformat(x: Inputs) -> DataFrame:
    return x.sql(DATE_TEXTS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    dates.short_date_text(F.col("short_text")).alias("closed_date"),
                                    dates.output_date_text(F.col("flow_text")).alias("output_date"),
                                    dates.slashed(F.col("dash_text")).alias("slashed_date"),
                                    dates.compact(F.col("flow_text")).alias("compact_date"))


_S = "((event_id * 37) % 86400)"
TIME_TEXTS = f"""
select event_id, case when event_id % 17 = 0 then null when event_id % 19 = 0 then '24:00:00' when event_id % 23 = 0 then ''
 when event_id % 29 = 0 then '13:05:01 PM' when event_id % 31 = 0 then concat({clock24(_S)}, 'PM')
 when event_id % 3 = 0 then {clock24(_S)} when event_id % 3 = 1 then concat(' ', {clock12(_S)}, ' ')
 else concat(cast(event_id % 24 as string), ':', cast(event_id % 60 as string), ':', cast(event_id % 60 as string)) end time_text,
 {clock24(_S)} full_time
from {{events}}"""
table("time_texts", K.plain(TIME_TEXTS))


@query("q_time_24h", f"select event_id, {K.clock('time_text')} order_time from time_texts")
def time_24h(x: Inputs) -> DataFrame:
    return x.sql(TIME_TEXTS).select("event_id", times.clock(F.col("time_text")).alias("order_time"))


@query("q_hour", "select event_id, hour(ts) order_hour from events")
def hour(x: Inputs) -> DataFrame:
    hour_of_day = times.hour(F.date_format("ts", "HH:mm:ss"))
    return x.table("events").select("event_id", hour_of_day.cast("bigint").alias("order_hour"))


@query("q_day_part_live", f"select event_id, {K.day_part('hour(ts)', 5)} day_part from events")
def day_part_live(x: Inputs) -> DataFrame:
    hour_of_day = times.hour(F.date_format("ts", "HH:mm:ss"))
    return x.table("events").select("event_id", times.day_part(hour_of_day).alias("day_part"))


@query("q_day_part_alt", f"select event_id, {K.day_part('hour(ts)', 4)} day_part from events")
def day_part_alt(x: Inputs) -> DataFrame:
    hour_of_day = times.hour(F.date_format("ts", "HH:mm:ss"))
    return x.table("events").select("event_id", times.day_part(hour_of_day, breakfast_start=4).alias("day_part"))


@query("q_week_number", f"select o_orderkey, {K.week_number('cast(o_orderdate as date)')} week_number from orders")
def week_number(x: Inputs) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return x.table("orders").select("o_orderkey", dates.week_number(day).cast("bigint").alias("week_number"))


@query("q_week_day", "select o_orderkey, isodow(o_orderdate) week_day from orders")
def week_day(x: Inputs) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return x.table("orders").select("o_orderkey", dates.week_day(day).cast("bigint").alias("week_day"))


@query("q_calendar_parts", """
select o_orderkey, month(o_orderdate) order_month, year(o_orderdate) order_year, '2024/01/02' processed from orders""")
def calendar_parts(x: Inputs) -> DataFrame:
    day = dates.flow_date(F.date_format("o_orderdate", dates.FLOW_FORMAT))
    return x.table("orders").select("o_orderkey", F.month(day).cast("bigint").alias("order_month"),
                                    F.year(day).cast("bigint").alias("order_year"), F.lit("2024/01/02").alias("processed"))


@query("q_state_dates", """
select c_custkey, strftime(date '1996-01-01' + cast(c_custkey % 700 as int), '%Y-%m-%d') first_day,
 case when c_custkey % 3 = 0 then '' else strftime(date '1998-01-01' + cast(c_custkey % 900 as int), '%Y-%m-%d') end unsubscribed
from customer""")
def state_dates(x: Inputs) -> DataFrame:
    text = F.date_format(F.date_add(F.lit("1998-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")), "yyyy-MM-dd")
    first = F.date_format(F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int")), "yyyy-MM-dd")
    stored = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(text)
    return x.table("customer").select("c_custkey",
                                      dates.state_date_text(dates.state_date(first)).alias("first_day"),
                                      dates.state_date_text(dates.state_date(stored), "").alias("unsubscribed"))


@query("q_weborder_repair", f"select o_orderkey, {K.repaired('WeborderNo')} web_order from raw_orders")
def weborder_repair(x: Inputs) -> DataFrame:
    return x.headers.select("o_orderkey", codes.web_order_number(F.col("WeborderNo")).alias("web_order"))


@query("q_order_keys", f"""
select o_orderkey, concat_ws('_', OrderId, strftime(inv, '%Y%m%d'), StoreCode) header_id,
 concat_ws('_', TransactionNo, PosTerminalNo, StoreCode, strftime(inv, '%Y%m%d')) orderwise_id
from (select *, {K.any_date('InvoiceDate')} inv from raw_orders) x""")
def order_keys(x: Inputs) -> DataFrame:
    day = dates.any_date_text(F.col("InvoiceDate"))
    return x.headers.select("o_orderkey", codes.header_id(F.col("OrderId"), day, F.col("StoreCode")).alias("header_id"),
                            codes.orderwise_id(F.col("TransactionNo"), F.col("PosTerminalNo"), F.col("StoreCode"), day)
                            .alias("orderwise_id"))


@query("q_prefix_label", """
select OrderNo, feed_date::varchar feed_day, Order_Date, case when Pasta_by_PH like 'PH%' then 'PizzaHut'
 when Pasta_by_PH like 'Pasta%' then 'PastaByPizzaHut' else Pasta_by_PH end brand from all_feed""")
def prefix_label(x: Inputs) -> DataFrame:
    return x.feed.select("OrderNo", F.col("feed_date").cast("string").alias("feed_day"), "Order_Date",
                         codes.prefix_label(shape.column("Pasta by PH"), BRAND_PREFIXES).alias("brand"))


@query("q_valid_txn", "select o_orderkey, EntryStatus is distinct from 'Voided' valid_transaction from raw_orders")
def valid_txn(x: Inputs) -> DataFrame:
    return x.headers.select("o_orderkey", codes.valid_transaction(F.col("EntryStatus")).alias("valid_transaction"))


_CATEGORY = "case l_suppkey % 5 when 0 then 'PIZZA' when 1 then 'Food' when 2 then 'pizza' when 3 then 'DRINK' end"


@query("q_item_base", f"""
select {_LINE}, case when lower({_CATEGORY}) in ('pizza', 'food') then concat('G', l_partkey % 9) end base from lineitem""")
def item_base(x: Inputs) -> DataFrame:
    rows = x.sql(f"select {_LINE}, {_CATEGORY} category, concat('G', cast(l_partkey % 9 as string)) grp from {{lineitem}}")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       codes.item_base(F.col("category"), F.col("grp")).alias("base"))


@query("q_upper_default", """
select OrderNo, Order_Date, coalesce(upper(nullif(Franchise, 'other')), 'DIL') franchise from all_feed""")
def upper_default(x: Inputs) -> DataFrame:
    return x.feed.select("OrderNo", "Order_Date",
                         codes.upper_or(F.nullif(F.col("Franchise"), F.lit("other")), "DIL").alias("franchise"))


@query("q_trim_case", """
select o_orderkey, trim(OrderSource) trimmed, lower(OrderSource) lowered, upper(OrderSource) uppered,
 coalesce(OrderSource, OrderType, 'none') first_known, abs(cast(OrderId as bigint) - 500) distance from raw_orders""")
def trim_case(x: Inputs) -> DataFrame:
    c = F.col("OrderSource")
    return x.headers.select("o_orderkey", F.trim(c).alias("trimmed"), F.lower(c).alias("lowered"),
                            F.upper(c).alias("uppered"), F.coalesce(c, F.col("OrderType"), F.lit("none")).alias("first_known"),
                            F.abs(F.col("OrderId").cast("bigint") - 500).alias("distance"))


@query("q_null_token", """
select o_orderkey, nullif(trim(kind), 'Unknown') shown, coalesce(trim(kind), 'Unknown') matched from (
 select o_orderkey, case when o_orderkey % 6 = 0 then 'Unknown' else OrderSource end kind from raw_orders) x""")
def null_token(x: Inputs) -> DataFrame:
    kind = F.when(F.col("o_orderkey") % 6 == 0, "Unknown").otherwise(F.col("OrderSource"))
    return x.headers.select("o_orderkey", shown_text(kind).alias("shown"), match_text(kind).alias("matched"))
