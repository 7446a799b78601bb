"""Queries of the whole daily run."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orderflow import contract as C
from orderflow.catalog import checks as K
from orderflow.catalog.fixtures import KEY, VECTOR, Inputs
from orderflow.catalog.registry import query
from orderflow.catalog.shapes import stored_orders
from orderflow.functions.privacy import decrypt, encrypt
from orderflow.operators.state import merge_customers
from orderflow.plans import daily
from orderflow.sources.readers import conform_stores
from orderflow.sources.scratch import staged

RUN_DATE = date(2024, 1, 2)


def orders(x: Inputs) -> daily.Orders:
    """The orders of a run over all orders. Each query reads the header once, so it is not written."""
    lookups = daily.Lookups(x.lookup, x.exceptions, x.dimension, staged(conform_stores(x.raw_stores), "stores"))
    repeated = daily.repeated_orders(x.orders)
    processed = stored_orders(daily.keyed_orders(x.orders, repeated)[0])
    return daily.build_orders(x.orders, x.own_feed, processed, lookups, RUN_DATE, stage=staged, repeated=repeated, last=daily.keep)


_HEADER_SQL = f"""
select h.Header_Id, Orderwise_Id, coalesce(upper(feed_franchise), 'DIL') Franchise, StoreCode Store_No,
 strftime(inv, '%Y-%m-%d') Invoice_Open_Date, strftime(order_date, '%Y-%m-%d') Enriched_Order_Date,
 filled_time Enriched_Order_Time, Channel_Id, Source, Channel, Fulfilment_Mode, {K.whole('Totalorderqty')} Order_Quantity,
 {K.number('NetAmount')} Net_Amount, {K.number('TotalOrderValue')} Gross_Amount, {K.number('SGST')} + {K.number('CGST')} Tax_Amount,
 {K.number('Totaldiscount')} Discount_Amount, case when t.Header_Id is not null then coalesce(t.modes, '') end Payment_Mode,
 t.gift Gift_Card, round(t.gift_total, 2) Gift_Card_Amount, year(order_date) order_year, month(order_date) order_month,
 isodow(order_date) order_week_day, {K.week_number('order_date')} order_week,
 cast(left(filled_time, 2) as int) Hour_Day_Part, {K.day_part('cast(left(filled_time, 2) as int)', 5)} Day_Part,
 web_no Enriched_WebOrderNo, case when Pasta_by_PH like 'PH%' then 'PizzaHut' when Pasta_by_PH like 'Pasta%' then 'PastaByPizzaHut'
 else Pasta_by_PH end PHDV_Pizzahut_Brand, Reference_No PHDV_Reference_No, strftime(inv, '%Y-%m-%d') Business_Date,
 strftime(strptime(left(BillCloseddate, 6) || '20' || right(BillCloseddate, 2), '%m/%d/%Y'), '%Y-%m-%d') Invoice_Closed_Date, {K.clock('BillClosetime')} Invoice_closed_Time,
 FZE StoreMaster_Franchise, State StoreMaster_State, '2024-01-02' System_Processed_Date,
 EntryStatus is distinct from 'Voided' Valid_Transaction
from header_rows h left join payment_totals t on t.Header_Id = h.Header_Id"""
_COLUMNS = ["Header_Id", "Orderwise_Id", "Franchise", "Store_No", "Invoice_Open_Date", "Enriched_Order_Date",
            "Enriched_Order_Time", "Channel_Id", "Source", "Channel", "Fulfilment_Mode", "Order_Quantity", "Net_Amount",
            "Gross_Amount", "Tax_Amount", "Discount_Amount", "Payment_Mode", "Gift_Card", "Hour_Day_Part", "Day_Part",
            "Enriched_WebOrderNo", "PHDV_Pizzahut_Brand", "PHDV_Reference_No", "Business_Date", "Invoice_Closed_Date",
            "Invoice_closed_Time", "StoreMaster_Franchise", "StoreMaster_State", "System_Processed_Date",
            "Valid_Transaction"]


@query("q_baseline", _HEADER_SQL)
def baseline(x: Inputs) -> DataFrame:
    rows = daily.baseline_facts(orders(x))
    calendar = {"order_year": "Year", "order_month": "Month", "order_week_day": "Week_Day", "order_week": "Week_Number"}
    return rows.select(*_COLUMNS, F.round("Gift_Card_Amount", 2).alias("Gift_Card_Amount"),
                       *[F.col(c).cast("bigint").alias(a) for a, c in calendar.items()])


@query("q_line", f"""
select h.Header_Id || '_' || a.i Line_Id, a.it_ItemNo Item_No, {K.number('a.it_NetAmount')} Line_Net_Amount,
 {K.day_part('cast(left(filled_time, 2) as int)', 5)} Day_Part, strftime(order_date, '%Y-%m-%d') Invoice_Open_Date,
 filled_time Invoice_Open_Time, feed_franchise Franchise
from header_rows h join all_items a using (o_orderkey)""")
def line(x: Inputs) -> DataFrame:
    return daily.line_facts(orders(x)).select("Line_Id", "Item_No", "Line_Net_Amount", "Day_Part",
                                                     "Invoice_Open_Date", "Invoice_Open_Time", "Franchise")


@query("q_payment", f"""
select h.Header_Id || '_' || p.i Payment_Id, p.pay_Mode Tender_Name, {K.number('p.pay_Amount', False)} Gross,
 strftime(strptime(p.pay_Date, '%m/%d/%y'), '%Y-%m-%d') Tender_date, strftime(order_date, '%Y-%m-%d') Invoice_Open_Date,
 {K.clock('h.BillClosetime')} Tender_time
from header_rows h join all_payments p using (o_orderkey)""")
def payment(x: Inputs) -> DataFrame:
    return daily.payment_facts(orders(x)).select("Payment_Id", "Tender_Name", "Gross", "Tender_date",
                                                        "Invoice_Open_Date", "Tender_time")


@query("q_daily_sales", f"""
select strftime(order_date, '%Y-%m-%d') order_date, StoreCode store, count(*) order_count,
 round(sum({K.number('NetAmount')}), 2) net_amount, round(sum({K.number('SGST')} + {K.number('CGST')}), 2) tax_amount
from header_rows group by 1, 2""")
def daily_sales(x: Inputs) -> DataFrame:
    rows = daily.baseline_facts(orders(x))
    return rows.groupBy(F.col("Enriched_Order_Date").alias("order_date"), F.col("Store_No").alias("store")).agg(
        F.count(F.lit(1)).alias("order_count"), F.round(F.sum("Net_Amount"), 2).alias("net_amount"),
        F.round(F.sum("Tax_Amount"), 2).alias("tax_amount"))


@query("q_day_rejects", """
select OrderId, 'mandatory_missing' reason from raw_orders where TotalOrderValue is null or Totalorderqty is null
union all select OrderId, 'unmapped_channel' from mapped_orders where Source is null and Channel is null and Fulfilment_Mode is null""")
def day_rejects(x: Inputs) -> DataFrame:
    parts = [rows.select("OrderId", F.lit(reason).alias("reason")) for reason, rows in orders(x).rejects.items()]
    return reduce(DataFrame.unionByName, parts)


@query("q_order_pii", """
select h.Header_Id, order_day, valid_phone Valid, StoreCode Store_No, filled_time Enriched_Order_Time, false Unsubscribed,
 coalesce(Latitude, '') latitude, coalesce(feed_email, Email, '') email, phone mobile from (
 select *, strftime(order_date, '%Y-%m-%d') order_day from (select * exclude order_day from header_rows) a) h""")
def order_pii(x: Inputs) -> DataFrame:
    rows = daily.order_pii_rows(daily.personal_rows(orders(x).header, KEY, VECTOR))
    shown = lambda c: F.coalesce(decrypt(F.col(c), KEY, VECTOR), F.lit(""))
    return rows.select("Header_Id", F.col("Enriched_Order_Date").alias("order_day"), "Valid", "Store_No",
                       "Enriched_Order_Time", "Unsubscribed", shown("Latitude").alias("latitude"),
                       shown("Email").alias("email"), shown("Mobile_Number").alias("mobile"))


@query("q_customer_day", """
select mobile, strftime(min(first_day), '%Y-%m-%d') First_Order_Date, strftime(max(last_day), '%Y-%m-%d') Last_Order_Date,
 arg_max(valid, (run, last_day, clock, hid)) Valid from (
 select phone mobile, order_date first_day, order_date last_day, valid_phone valid, 1 run, coalesce(filled_time, '') clock, Header_Id hid from header_rows
 union all select Mobile_Number, first_day, last_day, Valid, 0, '', '' from customer_state) r group by mobile having max(run) = 1""")
def customer_day(x: Inputs) -> DataFrame:
    delta = daily.customer_rows(daily.personal_rows(orders(x).header, KEY, VECTOR))
    stored = x.customers.withColumn("Mobile_Number", encrypt(F.col("Mobile_Number"), KEY, VECTOR)).select(*C.CUSTOMER_STATE_SCHEMA.fieldNames())
    merged = merge_customers(stored, delta, tie_break=["Order_Time", "Header_Id"])
    return merged.select(decrypt(F.col("Mobile_Number"), KEY, VECTOR).alias("mobile"), "First_Order_Date",
                         "Last_Order_Date", "Valid")


@query("q_mapping_day", """
select Header_Id, case when Aggregator_Order_ID is null or trim(Aggregator_Order_ID) = '' then '  ' else Aggregator_Order_ID end Aggregator_Id,
 StoreCode Store_No, Channel, Fulfilment_Mode Fullfillment, web_no Online_ref_ID, Reference_No, InvoiceNo Invoice_No,
 strftime(order_date, '%Y-%m-%d') Enriched_Order_Date, coalesce(upper(feed_franchise), 'DIL') Franchise from header_rows""")
def mapping_day(x: Inputs) -> DataFrame:
    rows = daily.mapping_rows(orders(x).header, KEY, VECTOR)
    return rows.select("Header_Id", "Aggregator_Id", "Store_No", "Channel", "Fullfillment", "Online_ref_ID", "Reference_No",
                       "Invoice_No", "Enriched_Order_Date", "Franchise")
