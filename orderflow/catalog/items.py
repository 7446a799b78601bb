"""Queries of items and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow import contract as C
from orderflow.catalog import checks as K
from orderflow.catalog.fixtures import Inputs
from orderflow.catalog.registry import query
from orderflow.catalog.shapes import complete_orders
from orderflow.functions import nested
from orderflow.operators import lines, shape
from orderflow.operators.quality import split_mandatory

_KEPT = ["Header_Id", "OrderId", "StoreCode"]
_ITEMS = ["ItemNo", "ItemCatagory", "Promono", "FoodType", "Quantity", "NetAmount"]


def receipts(x: Inputs) -> DataFrame:
    """Complete orders under shared receipts: forty orders of a store share a receipt number, on different days."""
    orders = complete_orders(x).withColumn("OrderId", F.floor(F.col("OrderId").cast("bigint") / 40).cast("string"))
    return orders.withColumn("Enriched_Order_Date", F.col("InvoiceDate"))


_RECEIPTS = "(select c.*, cast(o_orderkey // 40 as varchar) receipt from complete_orders c) r"


@query("q_items_flat", "select c.Header_Id, a.OrderId, a.StoreCode, "
       + ", ".join(f"a.it_{c} {c}" for c in _ITEMS) + " from complete_orders c join all_items a using (o_orderkey)")
def items_flat(x: Inputs) -> DataFrame:
    orders = complete_orders(x).withColumn("Enriched_Order_Date", F.col("InvoiceDate"))
    return lines.flatten_items(orders, _KEPT).select(*_KEPT, *_ITEMS)


@query("q_items_outer", """
select c.Header_Id, a.it_ItemNo ItemNo from complete_orders c left join all_items a using (o_orderkey)""")
def items_outer(x: Inputs) -> DataFrame:
    orders = complete_orders(x).withColumn("Enriched_Order_Date", F.col("InvoiceDate"))
    return lines.flatten_items(orders, _KEPT, outer=True).select("Header_Id", "ItemNo")


@query("q_item_line_no", f"""
select Header_Id, row_number() over (partition by receipt, StoreCode order by InvoiceDay, Header_Id, i) line_no, ItemNo
from (select r.Header_Id, r.receipt, r.StoreCode, r.InvoiceDay, a.i, a.it_ItemNo ItemNo
      from {_RECEIPTS} join all_items a using (o_orderkey)) x""")
def item_line_no(x: Inputs) -> DataFrame:
    rows = lines.flatten_items(receipts(x), _KEPT)
    return rows.select("Header_Id", F.col("Line_No").cast("bigint").alias("line_no"), "ItemNo")


@query("q_item_parent", """
select OrderId, i line_no, it_ItemNo item_no, case when it_ItemCatagory = 'TOPPING' then
 last_value(case when it_ItemCatagory = 'PIZZA' then it_ItemNo end ignore nulls)
  over (partition by o_orderkey order by i rows between unbounded preceding and current row) end parent_id from all_items""")
def item_parent(x: Inputs) -> DataFrame:
    rows = x.orders.select("OrderId", F.posexplode(nested.with_parents(F.col(lines.ITEMS))).alias("at", "row"))
    return rows.select("OrderId", (F.col("at") + 1).cast("bigint").alias("line_no"),
                       F.col("row.item.ItemNo").alias("item_no"), F.col("row.parent").alias("parent_id"))


@query("q_orders_deal_flags", """
select OrderId, case when n_items = 0 and o_orderkey % 4 = 0 then null else deals > 0 end deal,
 case when n_items = 0 and o_orderkey % 4 = 0 then null else n_items > deals end ala_carte
from (select h.OrderId, h.o_orderkey, h.n_items, count(a.it_Promono) deals from raw_orders h
      left join all_items a using (o_orderkey) group by all) x""")
def orders_deal_flags(x: Inputs) -> DataFrame:
    items = F.col(lines.ITEMS)
    return x.orders.select("OrderId", nested.any_with_promo(items).alias("deal"),
                           nested.any_without_promo(items).alias("ala_carte"))


@query("q_nonveg_flag", """
select OrderId, coalesce(bool_or(it_FoodType like '%Non Veg%'), false) non_veg
from (select h.OrderId, a.it_FoodType from raw_orders h left join all_items a using (o_orderkey)) x group by OrderId""")
def nonveg_flag(x: Inputs) -> DataFrame:
    return x.orders.select("OrderId", nested.any_non_veg(F.col(lines.ITEMS)).alias("non_veg"))


_PAID = ["Payment_Amount", "Payment_Date", "Payment_Mode", "Payment_TenderType"]


@query("q_payments_flat", f"""
select Header_Id, row_number() over (partition by receipt, StoreCode order by InvoiceDay, Header_Id, i) line_no,
 pay_Amount Payment_Amount, pay_Date Payment_Date, pay_Mode Payment_Mode, pay_TenderType Payment_TenderType
from (select r.Header_Id, r.receipt, r.StoreCode, r.InvoiceDay, p.i, p.pay_Amount, p.pay_Date, p.pay_Mode, p.pay_TenderType
      from {_RECEIPTS} join all_payments p using (o_orderkey)) x""")
def payments_flat(x: Inputs) -> DataFrame:
    rows = lines.flatten_payments(receipts(x), _KEPT)
    return rows.select("Header_Id", F.col("Line_No").cast("bigint").alias("line_no"), *_PAID)


@query("q_payment_summary", f"""
select OrderId, coalesce(string_agg(pay_Mode, ', ' order by i), '') payment_mode,
 coalesce(bool_or(pay_Mode = 'Gift Card'), false) gift_card,
 round(sum(case when pay_Mode = 'Gift Card' then {K.number('pay_Amount', False)} else 0.0 end), 2) gift_card_amount
from all_payments group by OrderId""")
def payment_summary(x: Inputs) -> DataFrame:
    rows = lines.with_payment_summary(x.orders).filter(F.col("Payment_Mode").isNotNull())
    return rows.select("OrderId", F.col("Payment_Mode").alias("payment_mode"), F.col("Gift_Card").alias("gift_card"),
                       F.round("Gift_Card_Amount", 2).alias("gift_card_amount"))


@query("q_payment_join", f"""
select h.OrderId, case when t.o_orderkey is not null then coalesce(t.modes, '') end payment_mode, t.gift gift_card
from raw_orders h left join (select o_orderkey, string_agg(pay_Mode, ', ' order by i) modes,
 coalesce(bool_or(pay_Mode = 'Gift Card'), false) gift from all_payments group by o_orderkey) t using (o_orderkey)""")
def payment_join(x: Inputs) -> DataFrame:
    rows = lines.with_payment_summary(x.orders)
    return rows.select("OrderId", F.col("Payment_Mode").alias("payment_mode"), F.col("Gift_Card").alias("gift_card"))


_LINE_TABLE = f"""
select c.Header_Id || '_' || a.i Line_Id, a.i Line_No, a.it_ItemNo Item_No, {K.whole('a.it_Quantity')} Quantity,
 {K.number('a.it_NetAmount')} Line_Net_Amount, {K.number('a.it_LineDiscount')} Line_Discount,
 {K.number('a.it_SGST')} + {K.number('a.it_CGST')} Tax_Amount, {K.number('a.it_StandardAmount')} Ala_Carte_price,
 case when lower(a.it_ItemCatagory) in ('pizza', 'food') then a.it_ProductGroup end Base, a.it_PromoName Deal_Name
from complete_orders c join all_items a using (o_orderkey)"""


@query("q_line_facts", _LINE_TABLE)
def line_facts(x: Inputs) -> DataFrame:
    orders = complete_orders(x).withColumn("Enriched_Order_Date", F.col("InvoiceDate"))
    orders = shape.add_placeholders(orders, ["Day_Part", "Store_Franchise", "Enriched_Order_Time", "Valid_Transaction"])
    rows = lines.line_facts(orders)
    return rows.select("Line_Id", F.col("Line_No").cast("bigint").alias("Line_No"), "Item_No", "Quantity", "Line_Net_Amount",
                       "Line_Discount", "Tax_Amount", "Ala_Carte_price", "Base", "Deal_Name")


@query("q_payment_facts", f"""
select c.Header_Id || '_' || p.i Payment_Id, p.i Line_No, strftime(strptime(p.pay_Date, '%m/%d/%y'), '%Y/%m/%d') Tender_date,
 p.pay_TenderType Tender_No, p.pay_Mode Tender_Name, {K.number('p.pay_Amount', False)} Gross
from complete_orders c join all_payments p using (o_orderkey)""")
def payment_facts(x: Inputs) -> DataFrame:
    orders = complete_orders(x).withColumn("Enriched_Order_Date", F.col("InvoiceDate"))
    rows = lines.payment_facts(shape.add_placeholders(orders, ["Enriched_Order_Time"]))
    return rows.select("Payment_Id", F.col("Line_No").cast("bigint").alias("Line_No"), "Tender_date", "Tender_No",
                       "Tender_Name", "Gross")


@query("q_mandatory_items", f"""
select OrderId, i line_no from all_items where it_ItemNo is null or it_Quantity is null or it_NetAmount is null
 or it_TotalRoundedAmount is null or it_Promono is null""")
def mandatory_items(x: Inputs) -> DataFrame:
    rows = x.orders.select("OrderId", "TransactionNo", "StoreCode", F.posexplode(lines.ITEMS).alias("at", "item"))
    flat = rows.select("OrderId", "TransactionNo", "StoreCode", (F.col("at") + 1).cast("bigint").alias("line_no"),
                       F.col("item.ItemNo"), F.col("item.Quantity"), F.col("item.NetAmount"),
                       F.col("item.TotalRoundedAmount"), F.col("item.Promono"))
    return split_mandatory(flat, C.MANDATORY_ITEM_COLUMNS + ["Promono"])[1].select("OrderId", "line_no")
