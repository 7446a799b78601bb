"""Queries of feed matching, channels and stores."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from orderflow.catalog import checks as K
from orderflow.catalog.fixtures import Inputs
from orderflow.catalog.registry import query
from orderflow.catalog.shapes import fresh_orders
from orderflow.functions.dates import FLOW_FORMAT
from orderflow.operators import channels, feed, shape
from orderflow.plans import daily
from orderflow.sources.readers import conform_stores, read_combinations, read_feed_table
from orderflow.sources.scratch import new_folder
from orderflow.sources.writers import write_keys


def match(x: Inputs, trailing: bool = True) -> DataFrame:
    orders = feed.with_web_order_number(fresh_orders(x))
    return feed.match_feed(orders, x.own_feed, trailing=trailing)


def named_match(df: DataFrame) -> DataFrame:
    return df.select("Header_Id", "Order_Date", shape.column("Order Time").alias("feed_time"),
                     shape.column("Reference No").alias("Reference_No"), feed.MATCH)


MATCH_SQL = """select Header_Id, replace(Order_Date, '-', '/') Order_Date, Order_Time feed_time, Reference_No, match_class
from {source} where {condition}"""


@query("q_same_day_match", MATCH_SQL.format(source="trailing_matches", condition="match_class = 'same_day'"))
def same_day_match(x: Inputs) -> DataFrame:
    return named_match(match(x).filter(F.col(feed.MATCH) == feed.SAME_DAY))


@query("q_other_day_match", MATCH_SQL.format(source="trailing_matches", condition="match_class = 'other_day'"))
def other_day_match(x: Inputs) -> DataFrame:
    return named_match(match(x).filter(F.col(feed.MATCH) == feed.OTHER_DAY))


@query("q_priority_match", MATCH_SQL.format(source="trailing_matches", condition="true"))
def priority_match(x: Inputs) -> DataFrame:
    return named_match(feed.split_match(match(x))[0])


@query("q_match_symmetric", MATCH_SQL.format(source="symmetric_matches", condition="true"))
def match_symmetric(x: Inputs) -> DataFrame:
    return named_match(feed.split_match(match(x, trailing=False))[0])


@query("q_unmatched", """
select Header_Id, web_no from fresh_orders where web_no is not null and Header_Id not in (select Header_Id from trailing_matches)""")
def unmatched(x: Inputs) -> DataFrame:
    return feed.split_match(match(x))[1].select("Header_Id", F.col("Enriched_WebOrder_No").alias("web_no"))


@query("q_match_counts", """
select coalesce(m.match_class, case when h.web_no is null then 'no_web_number' else 'unmatched' end) part, count(*) row_count
from fresh_orders h left join trailing_matches m on m.hkey = h.o_orderkey group by 1""")
def match_counts(x: Inputs) -> DataFrame:
    part = F.coalesce(feed.MATCH, F.when(F.col("Enriched_WebOrder_No").isNull(), "no_web_number").otherwise("unmatched"))
    return match(x).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("row_count"))


@query("q_window_days", """
select distinct strftime(cast(o_orderdate as date), '%Y/%m/%d') InvoiceDate, strftime(cast(o_orderdate as date) - d, '%Y/%m/%d') feed_day
from orders, unnest([0, 1, 2]) u(d)""")
def window_days(x: Inputs) -> DataFrame:
    return feed.invoice_days(x.table("orders").select(F.date_format("o_orderdate", FLOW_FORMAT).alias("InvoiceDate")))


@query("q_feed_scan", """
select OrderNo, Order_Date, strftime(date_trunc('month', feed_date), '%Y-%m-%d') feed_day from own_feed
where feed_date between date '1997-01-01' and date '1997-12-31'""")
def feed_scan(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "feed")
    monthly = x.feed.withColumn("feed_date", F.trunc("feed_date", "month"))
    monthly.hint("rebalance", F.col("feed_date")).write.partitionBy("feed_date").parquet(path)
    rows = read_feed_table(x.spark, path, date(1997, 1, 1), date(1997, 12, 31))
    return rows.select("OrderNo", "Order_Date", F.col("feed_date").cast("string").alias("feed_day"))


def _channel_input(x: Inputs) -> DataFrame:
    """Orders with the two texts the lookup reads, without a feed."""
    return x.headers.withColumns({"Header_Id": F.col("OrderId"), "Enriched_Sales_Channel": F.col("OrderSource"),
                                  "Enriched_Order_Type": F.col("OrderType")})


_OUT = ["Channel_Id", "Source", "Channel", "Fulfilment_Mode"]
_KEYS = "coalesce(trim(OrderSource), 'Unknown'), coalesce(trim(OrderType), 'Unknown')"


def _mapped_sql(rows: str, fold: str = "{}") -> str:
    side = lambda c: fold.format(f"coalesce(trim({c}), 'Unknown')")
    return f"""
select OrderId, trim(OrderSource) sales_channel, trim(OrderType) order_type, id Channel_Id, Source, Channel, Fulfilment_Mode
from raw_orders left join ({rows}) c on ch = {side('OrderSource')} and ty = {side('OrderType')}"""


def _mapped(df: DataFrame) -> DataFrame:
    return df.select("OrderId", F.col("Enriched_Sales_Channel").alias("sales_channel"),
                     F.col("Enriched_Order_Type").alias("order_type"), *_OUT)


@query("q_channel_map", _mapped_sql(K.channel_rows("lookup")))
def channel_map(x: Inputs) -> DataFrame:
    return _mapped(channels.map_channels(_channel_input(x), x.lookup, x.dimension))


@query("q_channel_map_ci", f"""
select OrderId, upper(trim(OrderSource)) sales_channel, trim(OrderType) order_type, id Channel_Id, Source, Channel, Fulfilment_Mode
from raw_orders left join ({K.channel_rows('lookup', 'lower({})')}) c
 on ch = lower(coalesce(trim(OrderSource), 'Unknown')) and ty = lower(coalesce(trim(OrderType), 'Unknown'))""")
def channel_map_ci(x: Inputs) -> DataFrame:
    rows = _channel_input(x).withColumn("Enriched_Sales_Channel", F.upper("OrderSource"))
    return _mapped(channels.map_channels(rows, x.lookup, x.dimension, case_sensitive=False))


def _override_sql(first: str, second: str) -> str:
    pick = lambda c: f"coalesce({first}.{c}, {second}.{c})"
    return f"""
select OrderId, {pick('id')} Channel_Id, {pick('Source')} Source, {pick('Channel')} Channel, {pick('Fulfilment_Mode')} Fulfilment_Mode
from raw_orders left join channel_rows old on old.ch = coalesce(trim(OrderSource), 'Unknown')
 and old.ty = coalesce(trim(OrderType), 'Unknown')
left join exception_rows new on WeborderNo is not null and new.ch = coalesce(trim(OrderSource), 'Unknown')
 and new.ty = coalesce(trim(OrderType), 'Unknown')"""


def _overridden(x: Inputs, precedence: str) -> DataFrame:
    mapped = channels.map_channels(_channel_input(x), x.lookup, x.dimension)
    return channels.override_channels(mapped, x.exceptions, x.dimension, precedence).select("OrderId", *_OUT)


@query("q_channel_override", _override_sql("new", "old"))
def channel_override(x: Inputs) -> DataFrame:
    return _overridden(x, "new")


@query("q_channel_override_old_wins", _override_sql("old", "new"))
def channel_override_old_wins(x: Inputs) -> DataFrame:
    return _overridden(x, "old")


_UNMAPPED = "Source is null and Channel is null and Fulfilment_Mode is null"
_MAPPED_ROWS = """raw_orders left join channel_rows on ch = coalesce(trim(OrderSource), 'Unknown')
 and ty = coalesce(trim(OrderType), 'Unknown')"""


@query("q_channel_missing", f"""
select OrderId, id Channel_Id, 'unmapped_channel' reject_reason from {_MAPPED_ROWS} where {_UNMAPPED}""")
def channel_missing(x: Inputs) -> DataFrame:
    mapped = channels.map_channels(_channel_input(x), x.lookup, x.dimension)
    return channels.split_unmapped(mapped)[1].select("OrderId", "Channel_Id", "reject_reason")


@query("q_channel_kept", f"select OrderId, id Channel_Id from {_MAPPED_ROWS} where not ({_UNMAPPED})")
def channel_kept(x: Inputs) -> DataFrame:
    mapped = channels.map_channels(_channel_input(x), x.lookup, x.dimension)
    return channels.split_unmapped(mapped)[0].select("OrderId", "Channel_Id")


@query("q_channel_id_filter", f"select OrderId, id Channel_Id from {_MAPPED_ROWS} where id is not null")
def channel_id_filter(x: Inputs) -> DataFrame:
    mapped = channels.map_channels(_channel_input(x), x.lookup, x.dimension)
    return channels.split_unmapped(mapped, strict_reference=True)[0].select("OrderId", "Channel_Id")


@query("q_channel_combos", f"select distinct OrderSource, OrderType, id Channel_Id from {_MAPPED_ROWS} where {_UNMAPPED}")
def channel_combos(x: Inputs) -> DataFrame:
    return channels.missing_combinations(channels.map_channels(_channel_input(x), x.lookup, x.dimension))


_COMBOS = """(select lower(Sales_Channel_Map) ch, lower(Order_Type_Map) ty, min(Channel_Id) id from lookup
 where Sales_Channel_Map is not null and Order_Type_Map is not null group by all) c"""


def _combinations(x: Inputs) -> tuple[DataFrame, DataFrame]:
    orders = x.headers.withColumns({"Header_Id": F.col("OrderId"), "OrderSource": F.upper(F.trim("OrderSource"))})
    combos = x.lookup.toDF("OrderSource_map", "OrderType_map", "Combination_Id")
    names = x.dimension.toDF("Combination_Id", "Enriched_Order_Type", "Enriched_Channel", "Fulfilment_Mode")
    path = new_folder(x.spark, "combinations")
    write_keys(combos, f"{path}/orders")
    write_keys(names, f"{path}/channels")
    combos, names = read_combinations(x.spark, f"{path}/orders", f"{path}/channels")
    return channels.combination_channels(orders, combos, names)


@query("q_combination_map", f"""
select OrderId Header_Id, id Combination_Id, Source Enriched_Order_Type, Channel Enriched_Channel, Fulfilment_Mode
from raw_orders left join {_COMBOS} on ch = lower(trim(OrderSource)) and ty = lower(OrderType)
left join dimension on Mapping_Channel_Id = id""")
def combination_map(x: Inputs) -> DataFrame:
    return _combinations(x)[0]


@query("q_combination_missing", f"""
select distinct upper(trim(OrderSource)) OrderSource, OrderType, cast(null as varchar) Combination_Id
from raw_orders left join {_COMBOS} on ch = lower(trim(OrderSource)) and ty = lower(OrderType) where id is null""")
def combination_missing(x: Inputs) -> DataFrame:
    return _combinations(x)[1]


@query("q_store_join", """
select OrderId, FZE StoreMaster_Franchise, s.City StoreMaster_Store_City, s.Tier StoreMaster_Tier_Category
from raw_orders h left join stores s on updated_code = StoreCode""")
def store_join(x: Inputs) -> DataFrame:
    rows = channels.join_stores(x.headers.withColumn("Header_Id", F.col("OrderId")), conform_stores(x.raw_stores))
    return rows.select("OrderId", "StoreMaster_Franchise", "StoreMaster_Store_City", "StoreMaster_Tier_Category")


@query("q_effective_channel", """
select Header_Id, match_class, sales_channel, order_type, Channel_Id, Source, Channel, Fulfilment_Mode from mapped_orders""")
def effective_channel(x: Inputs) -> DataFrame:
    lookups = daily.Lookups(x.lookup, x.exceptions, x.dimension, x.raw_stores)
    matched = daily.matched_orders(fresh_orders(x, "OrderSource", "OrderType"), x.own_feed)
    rows = daily.channelled_orders(matched, lookups)
    return rows.select("Header_Id", feed.MATCH, F.col("Enriched_Sales_Channel").alias("sales_channel"),
                       F.col("Enriched_Order_Type").alias("order_type"), *_OUT)
