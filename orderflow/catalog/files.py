"""Queries of sources and sinks: rows written to the shared folder and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from orderflow import contract as C
from orderflow.catalog.fixtures import Inputs
from orderflow.catalog.registry import query
from orderflow.functions.dates import FLOW_FORMAT
from orderflow.operators import quality, state
from orderflow.plans.daily import HEADER_IDS
from orderflow.sources import readers, writers
from orderflow.sources.scratch import new_folder


@query("q_xml_roundtrip", """
select h.OrderId, h.StoreCode, h.TotalOrderValue, h.PosTerminalNo, h.OrderSource, coalesce(a.i, 0) place, a.it_ItemNo ItemNo,
 a.it_Promono Promono, nullif(a.it_LineDiscount, '') LineDiscount
from raw_orders h left join all_items a using (o_orderkey)""")
def xml_roundtrip(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "orders-xml")
    (x.orders.write.format("xml").option("rowTag", C.ORDER_ROW_TAG).option("rootTag", "Orders")
     .option("compression", "gzip").option("maxRecordsPerFile", 100_000).save(path))
    rows = readers.read_orders(x.spark, path)
    flat = rows.select("OrderId", "StoreCode", "TotalOrderValue", "PosTerminalNo", "OrderSource",
                       F.posexplode_outer("ItemDetails.Items").alias("at", "item"))
    return flat.select("OrderId", "StoreCode", "TotalOrderValue", "PosTerminalNo", "OrderSource",
                       F.coalesce(F.col("at") + 1, F.lit(0)).cast("bigint").alias("place"), "item.ItemNo", "item.Promono",
                       "item.LineDiscount")


def _facts(x: Inputs) -> DataFrame:
    return x.table("orders").select(F.col("o_orderkey").cast("string").alias("Header_Id"),
                                    F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("Order_Date"),
                                    F.col("o_totalprice").alias("Net_Amount"))


_FACTS = """select o_orderkey::varchar Header_Id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') Order_Date,
 o_totalprice Net_Amount from orders"""


@query("q_partitioned_roundtrip", f"select *, Order_Date partition_date from ({_FACTS}) f")
def partitioned_roundtrip(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "facts")
    writers.write_facts(_facts(x), path, "Order_Date")
    writers.write_facts(_facts(x), path, "Order_Date")
    schema = T.StructType([*_facts(x).schema.fields, T.StructField(writers.PARTITION, T.StringType())])
    return x.spark.read.schema(schema).parquet(path)


@query("q_rejects_roundtrip", "select OrderId, 'late' reject_reason from raw_orders where TotalOrderValue is null")
def rejects_roundtrip(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "rejects")
    writers.write_rejects(x.headers.filter(F.col("TotalOrderValue").isNull()).select("OrderId"), path, "late")
    return x.spark.read.parquet(path)


@query("q_keys_csv", "select distinct OrderSource, OrderType from raw_orders")
def keys_csv(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "keys")
    writers.write_keys(x.headers.select("OrderSource", "OrderType").distinct(), path)
    return x.spark.read.option("header", True).schema("OrderSource string, OrderType string").csv(path)


@query("q_csv_lookup", """
select 'Seg ' || c_mktsegment Sales_Channel_Map, c_name Order_Type_Map, case when c_custkey % 4 = 0 then '-1' else c_custkey::varchar end Channel_Id
from customer""")
def csv_lookup(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "lookup")
    key = F.col("c_custkey")
    rows = x.table("customer").select(F.concat(F.lit("Seg "), "c_mktsegment").alias("Sales_Channel_Map"),
                                      F.col("c_name").alias("Order_Type_Map"),
                                      F.when(key % 4 != 0, F.concat(key.cast("string"), F.lit(".0"))).alias("Channel_Id"))
    rows.write.option("header", True).csv(path)
    return readers.read_channel_lookup(x.spark, path)


@query("q_store_master", """
select FZE StoreMaster_Franchise, Champs StoreMaster_Champ_Id, City StoreMaster_Store_City, State StoreMaster_State,
 Zone StoreMaster_Zone, Cluster StoreMaster_Cluster, Format StoreMaster_Format, Location StoreMaster_Location,
 Tier StoreMaster_Tier_Category, Region StoreMaster_Region, updated_code from stores""")
def store_master(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "stores")
    x.raw_stores.write.parquet(path)
    return readers.read_stores(x.spark, path)


@query("q_blocklist_read", "select distinct Mobile_Number number from customer_state")
def blocklist_read(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "blocklist")
    x.customers.select(F.concat_ws(" , ", "Mobile_Number", "Mobile_Number", F.lit("")).alias("value")).write.text(path)
    return readers.read_blocklist(x.spark, path)


_STORED = "cast(Header_Id as bigint) % 3 = 0"


@query("q_incremental_save", _FACTS)
def incremental_save(x: Inputs) -> DataFrame:
    path, facts = new_folder(x.spark, "saved"), _facts(x)
    writers.write_facts(facts.filter(F.col("Header_Id").cast("bigint") % 3 == 0), path, "Order_Date")
    writers.save_new_rows(facts, path, "Order_Date")
    return x.spark.read.schema(facts.schema).parquet(path).drop(writers.PARTITION)


@query("q_save_report", f"""
select Order_Date, count(*) total, count(*) filter (where not {_STORED}) saved, count(*) filter (where {_STORED}) skipped
from ({_FACTS}) f group by Order_Date""")
def save_report(x: Inputs) -> DataFrame:
    facts = _facts(x)
    return writers.save_report(facts, facts.filter(F.col("Header_Id").cast("bigint") % 3 == 0), "Order_Date")


@query("q_run_report", """
select 'read' stage, count(*) row_count from raw_orders union all
select 'rejected', count(*) from raw_orders where TotalOrderValue is null or Totalorderqty is null union all
select 'kept', count(*) from raw_orders where TotalOrderValue is not null and Totalorderqty is not null""")
def run_report(x: Inputs) -> DataFrame:
    kept, rejected = quality.split_mandatory(x.headers, C.MANDATORY_ORDER_COLUMNS)
    return quality.run_report({"read": x.headers, "rejected": rejected, "kept": kept})


@query("q_watermark_read", "select strftime(max(cast(o_orderdate as date)), '%Y/%m/%d') last_load_date from orders")
def watermark_read(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "control")
    x.table("orders").select(F.date_format("o_orderdate", FLOW_FORMAT).alias("dates")).distinct() \
        .write.option("header", True).csv(path)
    return readers.last_load_date(x.spark, path)


@query("q_watermark_append", """
select day from (select distinct strftime(cast(o_orderdate as date), '%Y/%m/%d') as day from orders union all select '2024/01/02') d""")
def watermark_append(x: Inputs) -> DataFrame:
    path = new_folder(x.spark, "control")
    x.table("orders").select(F.date_format("o_orderdate", "MM/dd/yyyy").alias("dates")).distinct() \
        .write.option("header", True).csv(path)
    writers.append_control_date(x.spark, path, date(2024, 1, 2))
    return readers.read_control_dates(x.spark, path).select(F.date_format("day", FLOW_FORMAT).alias("day"))


@query("q_snapshot_dump", "select Mobile_Number, Customer_Id, Valid from customer_state")
def snapshot_dump(x: Inputs) -> DataFrame:
    path = readers.day_folder(new_folder(x.spark, "snapshot"), date(2024, 1, 2))
    rows = x.customers.select("Mobile_Number", "Customer_Id", "Valid")
    writers.write_snapshot(rows, path)
    writers.write_snapshot(rows, path, files=2)
    return x.spark.read.parquet(path)


@query("q_missing_path_empty", """
select OrderId Header_Id, 'no' before, case when TotalOrderValue is null then 'no' else 'yes' end after from raw_orders""")
def missing_path_empty(x: Inputs) -> DataFrame:
    """Whether each order is stored, asked before anything is and once the complete ones are."""
    path, keys = new_folder(x.spark, "stored"), x.headers.select(F.col("OrderId").alias("Header_Id"))
    before = state.availability(keys, readers.read_or_empty(x.spark, path, HEADER_IDS))
    x.headers.filter(F.col("TotalOrderValue").isNotNull()).select(F.col("OrderId").alias("Header_Id")).write.parquet(path)
    after = state.availability(keys, readers.read_or_empty(x.spark, path, HEADER_IDS))
    return before.withColumnRenamed("available", "before").join(after.withColumnRenamed("available", "after"), "Header_Id")
