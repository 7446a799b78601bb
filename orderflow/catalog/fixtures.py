"""Order-shaped inputs derived from the given tables.

Each input is one SQL text that Spark and the checking engine both run, so the
two sides of a query start from the same rows. Items and payments of an order
are built from the order's own row, so no rows are gathered to nest them. The
given tables hold no nulls, hence nulls come from key arithmetic. Whole-number
division is written ``div``, which the checking side respells.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.contract import FEED_SCHEMA, RAW_ORDER_SCHEMA


def two(e: str) -> str:
    return f"lpad(cast({e} as string), 2, '0')"


def money(cents: str, sign: str = "-") -> str:
    """Text such as ``-112,946.26`` of a whole number of cents below 100 million."""
    units, thousand = f"(({cents}) div 100)", f"(({cents}) div 100000)"
    text = (f"concat('{sign}', case when {thousand} > 0 then concat(cast({thousand} as string), ',', "
            f"lpad(cast({units} % 1000 as string), 3, '0')) else cast({units} as string) end, '.', {two(f'({cents}) % 100')})")
    return f"coalesce({text}, '')"  # the tables hold no nulls; saying so lets null filters on the text fold away


def cents(e: str) -> str:
    return f"cast(round(({e}) * 100) as bigint)"


def clock24(s: str) -> str:
    return f"concat({two(_hour(s))}, ':', {two(_minute(s))}, ':', {two(f'({s}) % 60')})"


def clock12(s: str) -> str:
    h = _hour(s)
    return (f"concat({two(f'case when {h} % 12 = 0 then 12 else {h} % 12 end')}, ':', {two(_minute(s))}, ':', "
            f"{two(f'({s}) % 60')}, case when {h} < 12 then ' AM' else ' PM' end)")


def _hour(s: str) -> str:
    return f"(({s}) div 3600)"


def _minute(s: str) -> str:
    return f"(({s}) div 60) % 60"


_D, _M = two("day(o_orderdate)"), two("month(o_orderdate)")
_Y = "cast(year(o_orderdate) as string)"
_P9 = "lpad(cast((o_custkey * 7919) % 1000000000 as string), 9, '0')"
#: Orders name all stores and, for about one in nine, a number beyond the last that no store has.
_STORE_NO = "(o_custkey % (select max(s_suppkey) + max(s_suppkey) div 8 + 2 from {supplier}))"
_CODE = "concat('S', lpad(cast({n} as string), cast(greatest(3, length(cast({n} as string))) as int), '0'))"
_STORE = _CODE.replace("{n}", _STORE_NO)
_SECONDS = "((o_orderkey * 37) % 86400)"
_CLOSED = "((o_orderkey * 37 + 900) % 86400)"

ORDERS_SQL = f"""
select o_orderkey, o_custkey, cast(o_orderkey as string) OrderId, cast(o_orderkey * 7 + 1 as string) TransactionNo,
 {_STORE} StoreCode,
 case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 5 as string) end PosTerminalNo,
 case o_orderkey % 4 when 0 then concat({_D}, '-', {_M}, '-', substr({_Y}, 3, 2)) when 1 then concat({_M}, '/', {_D}, '/', {_Y})
   when 2 then concat({_Y}, '-', {_M}, '-', {_D}) else concat({_D}, '-', {_M}, '-', {_Y}) end InvoiceDate,
 case when o_orderkey % 13 = 0 then null when o_orderkey % 2 = 0 then {clock24(_SECONDS)} else {clock12(_SECONDS)} end InvoiceTime,
 concat({_M}, '/', {_D}, '/', substr({_Y}, 3, 2)) BillCloseddate, {clock12(_CLOSED)} BillClosetime,
 case o_orderkey % 4 when 0 then null when 1 then concat(cast(10000000 + o_orderkey as string), 'P')
   when 2 then concat(cast(10000000 + o_orderkey as string), '0') else cast(10000000 + o_orderkey as string) end WeborderNo,
 case when o_orderkey % 17 = 0 then null else {money(cents('o_totalprice'))} end TotalOrderValue,
 {money(cents('o_totalprice * 0.025'))} SGST, {money(cents('o_totalprice * 0.025'))} CGST,
 {money(cents('o_totalprice * 0.95'))} NetAmount, {money(cents('o_totalprice * 0.05'))} Totaldiscount,
 case when o_orderkey % 29 = 0 then null else concat('-', cast(1 + o_orderkey % 7 as string), '.00') end Totalorderqty,
 case o_orderstatus when 'P' then 'Voided' when 'F' then null else 'Posted' end EntryStatus,
 case o_orderstatus when 'P' then ' Web ' when 'F' then 'App' else null end OrderSource,
 case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end OrderType,
 case o_custkey % 8 when 0 then null when 1 then concat('0', '9', {_P9}) when 2 then concat('91', '8', {_P9})
   when 3 then concat('+91', '7', {_P9}) when 4 then concat('9 ', {_P9}) when 5 then '12345'
   when 6 then concat('5', {_P9}) else concat('6', {_P9}) end PhoneNo,
 case when o_custkey % 9 = 0 then null else concat('Customer ', cast(o_custkey as string)) end CustomerName,
 case when o_custkey % 5 = 0 then null else concat('c', cast(o_custkey as string), '@example.com') end Email,
 concat('City ', cast(o_custkey % 12 as string)) City, concat('Store ', cast({_STORE_NO} as string)) StoreName,
 concat('C', cast(o_orderkey % 3 as string)) Counter, concat('INV', cast(o_orderkey as string)) InvoiceNo,
 case when o_orderkey % 15 = 0 then concat('CP', cast(o_orderkey % 4 as string)) end CouponNo,
 case when o_orderkey % 2 = 0 then 'Yes' else 'No' end OriginatedFromStore,
 case when o_orderkey % 31 = 0 then cast(o_orderkey - 1 as string) end ReteriveFromReceiptNo,
 case when o_orderkey % 31 = 0 then 'Yes' else 'No' end SaleIsReturn,
 cast(o_orderkey % 6 as int) n_items, cast(case when o_orderkey % 23 = 0 then 0 else 1 + o_custkey % 3 end as int) n_payments
from {{orders}}"""

_NAMED = "case month(o_orderdate) " + " ".join(f"when {i} then '{m}'" for i, m in enumerate(
    "January February March April May June July August September October November December".split(), 1)) + " end"
_PLAIN_D, _PLAIN_M = "cast(day(o_orderdate) as string)", "cast(month(o_orderdate) as string)"
_ENDING = "case when day(o_orderdate) in (1, 21, 31) then 'st' when day(o_orderdate) in (2, 22) then 'nd' when day(o_orderdate) in (3, 23) then 'rd' else 'th' end"
#: Order days in free form; forms from 11 on name no day.
SPELLED_SQL = f"""
select o_orderkey, cast(o_orderdate as date) as day, cast(o_orderkey % 14 as int) form, case o_orderkey % 14
 when 0 then concat({_NAMED}, ' ', {_PLAIN_D}, ', ', {_Y}) when 1 then concat({_PLAIN_D}, ' ', substr({_NAMED}, 1, 3), ' ', {_Y})
 when 2 then concat('the ', {_PLAIN_D}, {_ENDING}, ' of ', {_NAMED}, ' ', {_Y})
 when 3 then concat('Tue, ', {_D}, ' ', upper(substr({_NAMED}, 1, 3)), ' ', {_Y}, ' 10:11:12 PM') when 4 then concat({_Y}, '.', {_M}, '.', {_D})
 when 5 then concat({_Y}, {_M}, {_D}) when 6 then concat(substr({_NAMED}, 1, 3), '-', {_D}, '-', {_Y})
 when 7 then concat({_D}, '-', substr({_NAMED}, 1, 3), '-', substr({_Y}, 3, 2)) when 8 then concat({_Y}, ' ', {_NAMED}, ' ', {_PLAIN_D})
 when 9 then concat({_Y}, '-', {_M}, '-', {_D}, 'T10:11:12Z') when 10 then concat({_PLAIN_M}, '.', {_PLAIN_D}, '.', {_Y})
 when 11 then 'soon' when 12 then concat({_Y}, '-13-45') else concat({_PLAIN_D}, ' ', {_NAMED}) end spelled
from {{orders}}"""

_PRICE = "((o_orderkey * 37 + i * 1013) % 250000 + 100)"
ITEM_SQL = {
    "CGST": money(f"{_PRICE} div 40"),
    "CouponNo": "case when (o_orderkey + i) % 10 = 0 then concat('K', cast(i as string)) end",
    "DiscountAmount": money(f"{_PRICE} div 20"),
    "FoodType": "case when (o_orderkey + 2 * i) % 3 = 0 then 'Non Veg' else 'Veg' end",
    "ItemCatagory": "case (o_custkey + i) % 4 when 0 then 'PIZZA' when 1 then 'TOPPING' when 2 then 'Food' else 'DRINK' end",
    "ItemName": "concat('Item ', cast((o_orderkey * 31 + i * 17) % 2000 as string))",
    "ItemNo": "cast((o_orderkey * 31 + i * 17) % 2000 as string)",
    "LineDiscount": "case when (o_orderkey + i) % 7 = 0 then '' else '0' end",
    "NetAmount": money(_PRICE),
    "ProductGroup": "concat('Group ', cast((o_orderkey + i) % 9 as string))",
    "PromoName": "case when (o_orderkey + i) % 3 = 0 then concat('Promo ', cast(i as string)) end",
    "Promono": "case when (o_orderkey + i) % 3 = 0 then cast(i as string) end",
    "Quantity": "concat('-', cast(1 + (o_orderkey + i) % 3 as string), case when i % 2 = 0 then '.00' else '' end)",
    "SGST": money(f"{_PRICE} div 40"),
    "SizeCode": "cast(i % 4 as string)",
    "StandardAmount": money(f"{_PRICE} + 500"),
    "TotalDiscount": money("i * 25"),
    "TotalRoundedAmount": money(f"({_PRICE} div 100) * 100"),
}
_PAID = "((o_orderkey * 53 + i * 7919) % 400000 + 50)"
PAYMENT_SQL = {
    "Amount": f"case when (o_orderkey + i) % 37 = 0 then null else {money(_PAID, '')} end",
    "Date": f"concat({two('1 + (o_orderkey + i) % 12')}, '/', {two('1 + (o_orderkey * 3 + i) % 28')}, '/24')",
    "Mode": "case (o_custkey + o_orderkey + i) % 5 when 0 then 'Gift Card' when 1 then 'Cash' when 2 then 'Card' "
            "when 3 then 'Wallet' end",
    "TenderType": "cast((o_orderkey + i) % 6 as string)",
}

_DELIVERED = "((o_orderkey * 53 + k * 3600) % 86400)"
_FEED_DAY = "cast(o_orderdate as date) + cast(o_orderkey % 6 - 3 + k as int)"
FEED_SQL = f"""
select concat('12.', cast(o_custkey % 90 as string)) Latitude, {_STORE} Store_Code,
 case when o_custkey % 7 = 0 then null else concat('77.', cast(o_custkey % 80 as string)) end Longitude,
 cast(10000000 + o_orderkey as string) OrderNo, case when o_custkey % 2 = 0 then 'true' else 'false' end marketing_Communication,
 concat(cast(year(od) as string), '-', {two('month(od)')}, '-', {two('day(od)')}) Order_Date,
 case when o_orderkey % 9 = 0 then null when k = 0 then {clock24(_DELIVERED)} else {clock12(_DELIVERED)} end Order_Time,
 case o_orderkey % 4 when 1 then 'PH Main' when 2 then 'Pasta' when 3 then 'Other' end Pasta_by_PH,
 cast(o_orderkey % 100 as string) Discount_Voucher_Code, cast(o_orderkey % 50 as string) Discount_Amount,
 concat('D', cast(o_orderkey % 8 as string)) discount_code, cast(o_orderkey % 3 as string) Discount_type_ID,
 case when o_orderkey % 2 = 0 then 'flat' else 'percent' end Discount_type_type, '0' Discount_appexclusive,
 cast(o_orderkey % 30 as string) Discount_value,
 case o_orderkey % 3 when 0 then null when 1 then ' ' else concat('AG', cast(o_orderkey as string)) end Aggregator_Order_ID,
 case when o_custkey % 6 = 0 then concat('9', {_P9}) end MobileNo,
 case when o_custkey % 10 = 0 then concat('feed', cast(o_custkey as string), '@example.com') end Email,
 'Delivered' Order_Status, case o_orderkey % 3 when 0 then 'Delivery' when 1 then 'Takeaway' end Order_Type,
 case o_custkey % 4 when 0 then 'Web' when 1 then 'App' end New_Channel, concat('R', cast(o_orderkey as string)) Reference_No,
 'No' Gift_Card, '0' Gift_card_amount, cast(null as string) Gift_card_No, 'src' utm_source, 'med' utm_medium,
 concat('camp', cast(o_orderkey % 5 as string)) utm_campaign,
 case when o_orderkey % 10 = 3 then 'other' else 'dil' end Franchise,
 od + cast(case when o_orderkey % 7 = 0 then 1 else 0 end as int) feed_date
from (select o_orderkey, o_custkey, k, {_FEED_DAY} od
      from (select o.*, 0 k from {{orders}} o union all select o.*, 1 k from {{orders}} o) twice
      where o_orderkey % 4 <> 0 and o_orderkey % 5 <> 0 and (k = 0 or o_orderkey % 3 = 0)) rows"""

LOOKUP_SQL = """
select * from (values ('Web', '1-URGENT', '1'), ('Web', '2-HIGH', '2'), ('Web', '3-MEDIUM', '3'), ('Web', '5-LOW', '4'),
 ('Web', cast(null as string), '5'), ('App', '1-URGENT', '6'), ('App', '2-HIGH', '7'), ('App', '3-MEDIUM', '8'),
 ('App', '5-LOW', '9'), ('App', ' 5-LOW ', '10'), (cast(null as string), '1-URGENT', '11'),
 (cast(null as string), '2-HIGH', '12'), (cast(null as string), '3-MEDIUM', '13'),
 (cast(null as string), cast(null as string), '14'), (cast(null as string), '5-LOW', '99'), ('Web', 'Delivery', '15'),
 ('App', 'Delivery', '16'), (cast(null as string), 'Delivery', '17'), ('Web', 'Takeaway', '18'),
 ('App', 'Takeaway', '19')) as t(Sales_Channel_Map, Order_Type_Map, Channel_Id)"""
EXCEPTIONS_SQL = """
select * from (values ('Web', 'Delivery', '20'), ('App', '5-LOW', '21'), (cast(null as string), '1-URGENT', '97'))
 as t(Sales_Channel_Map, Order_Type_Map, Channel_Id)"""
DIMENSION_SQL = """
select cast(n as string) Mapping_Channel_Id, case when n % 3 = 0 then 'Online' when n % 3 = 1 then 'Offline' else 'Partner' end Source,
 concat('Channel ', cast(n as string)) Channel, case when n % 2 = 0 then 'Delivery' else 'Pickup' end Fulfilment_Mode
from (values (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15), (16), (17), (18), (19),
 (20), (21)) as t(n)"""
STORES_SQL = """
select concat('Owner ', cast(s_nationkey as string)) FZE, concat('CH', cast(s_suppkey as string)) Champs,
 concat('Town ', cast(s_suppkey % 9 as string)) City, concat('State ', cast(s_suppkey % 4 as string)) State,
 concat('Zone ', cast(s_suppkey % 3 as string)) Zone, concat('Cluster ', cast(s_suppkey % 5 as string)) Cluster,
 'Format' Format, 'High street' Location, concat('Tier ', cast(s_suppkey % 2 as string)) Tier,
 concat('Region ', cast(s_suppkey % 6 as string)) Region, """ + _CODE.replace("{n}", "s_suppkey") + """ updated_code
from {supplier}"""

CUSTOMERS_SQL = """
select concat('9', lpad(cast((c_custkey * 7919) % 1000000000 as string), 9, '0')) Mobile_Number,
 concat('C', cast(c_custkey as string)) Customer_Id, date '1996-01-01' + cast(c_custkey % 700 as int) first_day,
 date '1998-01-01' + cast(c_custkey % 900 as int) last_day, c_custkey % 3 = 0 Valid, c_custkey % 11 = 0 Unsubscribed,
 case when c_custkey % 11 = 0 then '1999-06-01' else '' end Unsubscribe_Date
from {customer}"""

EVENT_TIMES_SQL = f"""
select event_id, concat(cast(year(ts) as string), '/', {two('month(ts)')}, '/', {two('day(ts)')}) InvoiceDate,
 concat('S', cast(user_id % 5 as string)) StoreCode,
 case when event_id % 7 = 0 or (user_id % 5 = 3 and day(ts) % 4 = 0) then null
   else concat({two('hour(ts)')}, ':', {two('minute(ts)')}, ':', {two('cast(floor(second(ts)) as int)')}) end Enriched_Order_Time,
 cast(event_id as string) Header_Id
from {{events}}"""

#: Orders that one task builds.
TASK_ROWS = 200_000
KEY, VECTOR = "0123456789abcdef0123456789abcdef", "abcdefghijklmnop"


def _array(fields: dict[str, str], count: str) -> str:
    pairs = ", ".join(f"'{name}', cast({e} as string)" for name, e in fields.items())
    return f"transform(slice(sequence(0, {count}), 2, {count}), i -> named_struct({pairs}))"


class Inputs:
    """The given tables of one scale and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        names = [n for n in ("orders", "lineitem", "events", "customer", "supplier") if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: self.table(n) for n in names if n not in frames}, **frames)

    @cached_property
    def order_table(self) -> DataFrame:
        """The orders table, spread where its scan has fewer tasks than cores or than one for ``TASK_ROWS`` orders.

        A nested order is some thirty times as large as the row it is built from, so tasks are cut by rows, not by size.
        """
        orders, cores = self.table("orders"), self.spark.sparkContext.defaultParallelism
        tasks = max(cores, -(-orders.count() // TASK_ROWS))
        return orders.repartition(tasks, "o_orderkey") if orders.rdd.getNumPartitions() < tasks else orders

    @cached_property
    def headers(self) -> DataFrame:
        """Raw orders without their arrays, all text, and the size of each array."""
        return self.sql(ORDERS_SQL, orders=self.order_table)

    @cached_property
    def orders(self) -> DataFrame:
        """Raw nested orders; an order without items has an empty array or none."""
        items = f"case when n_items = 0 and o_orderkey % 4 = 0 then null else {_array(ITEM_SQL, 'n_items')} end"
        nested = self.sql(f"select *, named_struct('Items', {items}) ItemDetails, "
                          f"named_struct('Payments', {_array(PAYMENT_SQL, 'n_payments')}) PaymentsDetails from {{h}}",
                          h=self.headers)
        return nested.select([F.col(f.name).cast(f.dataType) for f in RAW_ORDER_SCHEMA.fields])

    @cached_property
    def feed(self) -> DataFrame:
        """All feed rows, with the day of their folder."""
        rows = self.sql(FEED_SQL, orders=self.order_table)
        return rows.withColumnsRenamed({f.name.replace(" ", "_"): f.name for f in FEED_SCHEMA.fields})

    @cached_property
    def own_feed(self) -> DataFrame:
        return self.feed.filter(F.col("Franchise") == "dil")

    @cached_property
    def lookup(self) -> DataFrame:
        return self.sql(LOOKUP_SQL)

    @cached_property
    def exceptions(self) -> DataFrame:
        return self.sql(EXCEPTIONS_SQL)

    @cached_property
    def dimension(self) -> DataFrame:
        return self.sql(DIMENSION_SQL)

    @cached_property
    def raw_stores(self) -> DataFrame:
        return self.sql(STORES_SQL)

    @cached_property
    def customers(self) -> DataFrame:
        """Customer state as stored: numbers in clear here, dates as text."""
        text = "select Mobile_Number, Customer_Id, date_format(first_day, 'yyyy-MM-dd') First_Order_Date, " \
               "date_format(last_day, 'yyyy-MM-dd') Last_Order_Date, Valid, Unsubscribed, Unsubscribe_Date from {c}"
        return self.sql(text, c=self.sql(CUSTOMERS_SQL))

    @cached_property
    def event_times(self) -> DataFrame:
        return self.sql(EVENT_TIMES_SQL)
