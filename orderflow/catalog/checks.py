"""Steps of the checking SQL, written for the checking engine from the rules themselves.

They follow the data flow order by order with plain joins and windows and share
nothing with the Spark side but the input texts.
"""

from __future__ import annotations

from orderflow.catalog import fixtures as X
from orderflow.catalog.registry import table


def plain(text: str) -> str:
    """An input text as the checking engine spells it."""
    return text.replace("{", "").replace("}", "").replace(" div ", " // ")


def fields(sql: dict[str, str], prefix: str) -> str:
    return plain(", ".join(f"{e} as {prefix}{name}" for name, e in sql.items()))


def number(text: str, negate: bool = True) -> str:
    sign = "-" if negate else ""
    return f"({sign}try_cast(replace({text}, ',', '') as double) + 0.0)"


def whole(text: str) -> str:
    return f"cast(trunc(abs(try_cast(replace({text}, ',', '') as double))) as integer)"


_FORMATS = ["%d-%m-%y", "%d-%m-%Y", "%m/%d/%y", "%m/%d/%Y", "%Y-%m-%d", "%Y/%m/%d"]


def any_date(text: str) -> str:
    return "cast(coalesce(" + ", ".join(f"try_strptime({text}, '{f}')" for f in _FORMATS) + ") as date)"


def clock(text: str) -> str:
    return (f"strftime(coalesce(try_strptime(trim({text}), '%H:%M:%S'), try_strptime(trim({text}), '%I:%M:%S %p')), "
            f"'%H:%M:%S')")


def repaired(text: str) -> str:
    return (f"case when {text} like '%P' or {text} like '%p' then left({text}, -1) "
            f"when length({text}) = 9 and {text} like '%0' then left({text}, -1) else {text} end")


def cleaned_phone(text: str) -> str:
    t = f"replace({text}, ' ', '')"
    return (f"case when length({t}) = 11 and {t} like '0%' then substr({t}, 2) "
            f"when length({t}) = 12 and {t} like '91%' then substr({t}, 3) "
            f"when length({t}) = 13 and {t} like '+91%' then substr({t}, 4) else {t} end")


def week_number(day: str) -> str:
    return f"(({day} - cast(date_trunc('week', make_date(year({day}), 1, 1)) as date)) // 7 + 1)"


def day_part(hour: str, breakfast: int) -> str:
    return (f"case when {hour} between 11 and 14 then 'Lunch' when {hour} between 15 and 18 then 'Snack' "
            f"when {hour} between 19 and 22 then 'Dinner' when {hour} >= 23 or {hour} < {breakfast} then 'Late night' "
            f"when {hour} between {breakfast} and 10 then 'Breakfast' end")


table("raw_orders", plain(X.ORDERS_SQL))
table("all_items", f"select h.*, i, {fields(X.ITEM_SQL, 'it_')} from raw_orders h, unnest(range(1, n_items + 1)) u(i)")
table("all_payments",
      f"select h.*, i, {fields(X.PAYMENT_SQL, 'pay_')} from raw_orders h, unnest(range(1, n_payments + 1)) u(i)")
table("all_feed", plain(X.FEED_SQL))
table("own_feed", "select *, cast(Order_Date as date) od from all_feed where Franchise = 'dil'")
table("lookup", X.LOOKUP_SQL)
table("exceptions", X.EXCEPTIONS_SQL)
table("dimension", X.DIMENSION_SQL)
table("stores", plain(X.STORES_SQL))
table("customer_state", plain(X.CUSTOMERS_SQL))
table("event_times", plain(X.EVENT_TIMES_SQL))

table("complete_orders", f"""
select *, replace(InvoiceDay, '/', '') compact_day,
 concat_ws('_', OrderId, replace(InvoiceDay, '/', ''), StoreCode) Header_Id,
 concat_ws('_', TransactionNo, PosTerminalNo, StoreCode, replace(InvoiceDay, '/', '')) Orderwise_Id,
 case when WeborderNo is not null then {repaired('WeborderNo')} end web_no
from (select *, strftime(inv, '%Y/%m/%d') InvoiceDay
      from (select *, {any_date('InvoiceDate')} inv from raw_orders
            where TotalOrderValue is not null and Totalorderqty is not null) a) b""")
table("stored_orders", "select Header_Id from complete_orders where o_orderkey % 10 = 0")
table("fresh_orders", "select * from complete_orders where Header_Id not in (select Header_Id from stored_orders)")


def matches(first: str, last: str, orders: str = "fresh_orders", feed: str = "own_feed") -> str:
    """Each web order with its preferred feed row among the feed days in the window."""
    return f"""
select * from (
 select h.o_orderkey hkey, h.Header_Id, h.inv, f.*, case when f.od = h.inv then 'same_day' else 'other_day' end match_class,
  row_number() over (partition by h.Header_Id order by (f.od = h.inv) desc, abs(f.od - h.inv), f.od desc,
                     f.Order_Time nulls last) pick
 from {orders} h join {feed} f on f.Store_Code = h.StoreCode and f.OrderNo = h.web_no
  and f.feed_date between {first} and {last}) c where pick = 1"""


table("trailing_matches", matches("h.inv - 2", "h.inv"))
table("symmetric_matches", matches("h.inv - 2", "h.inv + 2"))
table("matched_orders", """
select h.*, m.match_class, m.od, m.Order_Date feed_day, m.Order_Time feed_time, m.Order_Type feed_type, m.New_Channel,
 m.MobileNo, m.Email feed_email, m.Latitude, m.Longitude, m.Aggregator_Order_ID, m.Reference_No, m.Pasta_by_PH,
 m.Franchise feed_franchise, m.utm_campaign, trim(coalesce(m.New_Channel, h.OrderSource)) sales_channel,
 trim(coalesce(m.Order_Type, h.OrderType)) order_type
from fresh_orders h left join trailing_matches m on m.hkey = h.o_orderkey""")


def channel_rows(source: str, fold: str = "{}") -> str:
    key = lambda c: fold.format(f"coalesce(trim({c}), 'Unknown')")
    return f"""
select ch, ty, id, Source, Channel, Fulfilment_Mode from (
 select {key('Sales_Channel_Map')} ch, {key('Order_Type_Map')} ty, Channel_Id id,
  row_number() over (partition by {key('Sales_Channel_Map')}, {key('Order_Type_Map')} order by cast(Channel_Id as int)) n
 from {source}) x left join dimension on Mapping_Channel_Id = id where n = 1"""


table("channel_rows", channel_rows("lookup"))
table("exception_rows", channel_rows("exceptions"))
table("first_mapped", """
select h.*, c.id id1, c.Source src1, c.Channel ch1, c.Fulfilment_Mode mode1, e.id id2, e.Source src2, e.Channel ch2,
 e.Fulfilment_Mode mode2
from matched_orders h left join channel_rows c on c.ch = coalesce(h.sales_channel, 'Unknown')
 and c.ty = coalesce(h.order_type, 'Unknown')
left join exception_rows e on h.WeborderNo is not null and e.ch = coalesce(h.sales_channel, 'Unknown')
 and e.ty = coalesce(h.order_type, 'Unknown')""")
table("mapped_orders", """
select *, coalesce(id2, id1) Channel_Id, coalesce(src2, src1) Source, coalesce(ch2, ch1) Channel,
 coalesce(mode2, mode1) Fulfilment_Mode from first_mapped""")
table("kept_orders",
      "select * from mapped_orders where Source is not null or Channel is not null or Fulfilment_Mode is not null")
table("timed_orders", f"""
select *, coalesce({clock('feed_time')}, {clock('InvoiceTime')}) own_time,
 coalesce(replace(feed_day, '-', '/'), InvoiceDay) order_day, coalesce(od, inv) order_date from kept_orders""")


def filled(source: str, day: str, store: str, time: str, key: str) -> str:
    """Every row with its time, or the last time in (day, store) order plus its place among the missing ones."""
    return f"""
select *, case when {time} is not null then {time} when carried is null then null else
 strftime(cast('2000-01-01 ' || carried as timestamp) + to_seconds(cast(place - 1 as int)), '%H:%M:%S') end filled_time
from (select *, last_value({time} ignore nulls) over (order by {day}, {store}, ({time} is null), {time}
        rows between unbounded preceding and current row) carried,
       row_number() over (partition by {day}, {store}, ({time} is null) order by md5({key}), {key}) place from {source}) c"""


table("filled_orders", filled("timed_orders", "InvoiceDay", "StoreCode", "own_time", "Header_Id"))
table("counted_orders", f"""
select *, {cleaned_phone('raw_phone')} cleaned from (
 select *, coalesce(MobileNo, PhoneNo) raw_phone,
  count(*) over (partition by coalesce(MobileNo, PhoneNo), InvoiceDay) daily from filled_orders) c""")
table("phoned_orders", """
select *, coalesce(case when daily < 4 and regexp_full_match(cleaned, '91[6789][0-9]{10}') then substr(cleaned, 3)
   else cleaned end, 'xxxxxxxxxx') phone,
 coalesce(daily < 4 and ((length(cleaned) = 10 and substr(cleaned, 1, 1) in ('9', '8', '7', '6'))
   or regexp_full_match(cleaned, '91[6789][0-9]{10}')), false) valid_phone from counted_orders""")
table("header_rows", """
select h.*, s.* from phoned_orders h left join stores s on s.updated_code = h.StoreCode""")
table("payment_totals", f"""
select Header_Id, string_agg(pay_Mode, ', ' order by i) modes, coalesce(bool_or(pay_Mode = 'Gift Card'), false) gift,
 sum(case when pay_Mode = 'Gift Card' then {number('pay_Amount', False)} else 0.0 end) gift_total
from (select h.Header_Id, p.i, p.pay_Mode, p.pay_Amount from fresh_orders h join all_payments p using (o_orderkey)) x
group by Header_Id""")
