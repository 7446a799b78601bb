"""Matching web orders to the aggregator feed within a window of days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.contract import FEED_DATE, FEED_EMAIL, FEED_WINDOW_DAYS
from orderflow.functions.codes import web_order_number
from orderflow.functions.dates import FLOW_FORMAT, SLASHED, any_date, flow_date, slashed
from orderflow.operators.dedupe import dedupe_rare, row_values
from orderflow.operators.shape import column
from orderflow.operators.skew import lookup_join

MATCH = "match_class"
SAME_DAY, OTHER_DAY = "same_day", "other_day"

_SERVED, _STORE, _NUMBER, _DAY, _LOOKED = "_served", "_store", "_number", "_order_day", "_looked"
_ASKED_STORE, _ASKED_NUMBER, _ASKED_BLOCK = "_asked_store", "_asked_number", "_asked_block"
_FIRST, _LAST, _BLOCK, _RANK = "_first_day", "_last_day", "_block", "_rank"
_DIGESTS = {m: f"_{m}_digest" for m in (SAME_DAY, OTHER_DAY)}
_ROW = "_row"
_SPAN = 64  # days that one piece of the join by store and number holds


def window_days(day: Column, days: int = FEED_WINDOW_DAYS, trailing: bool = True) -> Column:
    """Feed days looked at for an invoice day: up to that day, or on both sides of it."""
    return F.sequence(F.date_sub(day, days), day if trailing else F.date_add(day, days))


def served_days(feed_day: Column, days: int = FEED_WINDOW_DAYS, trailing: bool = True) -> Column:
    """Invoice days that look at a feed day: ``window_days`` seen from the other side."""
    return F.sequence(feed_day if trailing else F.date_sub(feed_day, days), F.date_add(feed_day, days))


def invoice_day_list(orders: DataFrame) -> DataFrame:
    """Distinct invoice days of orders as dates, one row per calendar day.

    Taking readable dates by a filter also tells Spark that the list is selective,
    on which it decides whether a scan is worth pruning by it.
    """
    text = F.col("InvoiceDate")
    return orders.filter(text.rlike(SLASHED)).select(text).distinct().select(flow_date(text).alias(_SERVED)).distinct()


def feed_days(orders: DataFrame, days: int = FEED_WINDOW_DAYS, trailing: bool = True) -> list[date]:
    """The feed days that orders look at, in order: what to read of a feed kept in folders by day.

    At most one row per calendar day comes to the driver.
    """
    looked = F.explode(window_days(F.col(_SERVED), days, trailing)).alias(_LOOKED)
    return sorted(r[0] for r in invoice_day_list(orders).select(looked).distinct().collect() if r[0] is not None)


def with_web_order_number(orders: DataFrame) -> DataFrame:
    return orders.withColumn("Enriched_WebOrder_No", web_order_number(F.col("WeborderNo")))


def _span(day: Column) -> Column:
    return F.floor(F.unix_date(day) / _SPAN)


def asked_keys(orders: DataFrame) -> DataFrame:
    """The distinct store, number and invoice day of orders with a web order number, with the span of days."""
    keys = orders.select(F.col("StoreCode").alias(_ASKED_STORE), F.col("Enriched_WebOrder_No").alias(_ASKED_NUMBER),
                         flow_date(F.col("InvoiceDate")).alias(_SERVED))
    return keys.dropna().distinct().withColumn(_ASKED_BLOCK, _span(F.col(_SERVED)))


def best_feed_rows(orders: DataFrame, feed: DataFrame, days: int = FEED_WINDOW_DAYS,
                   trailing: bool = True) -> DataFrame:
    """The preferred feed row per (store, order number, invoice day) that some order has.

    A row of the same day wins, then the nearest order day, the later one, the
    earlier time; rows that agree in all of these go by a 64-bit digest of the whole row.
    Order dates are read in any known spelling and carried on as
    ``yyyy/MM/dd``; a row whose date cannot be read still matches, as another day
    and after all others, with the date as it came. Rows without a date, a store or
    a number match nothing.

    Only feed days that some order looks at are read: where the feed is a table
    partitioned by ``feed_date``, Spark prunes its scan at run time by the days of the
    orders; that list is one row per calendar day. The rows read meet the distinct keys of
    the orders once, by store, number and span of ``_SPAN`` days, and are repeated for
    invoice days only there.
    """
    wanted = invoice_day_list(orders)
    looked = wanted.select(F.explode(window_days(F.col(_SERVED), days, trailing)).alias(_LOOKED)).distinct()
    feed = feed.join(F.broadcast(looked), F.col(FEED_DATE) == F.col(_LOOKED), "left_semi")
    given = F.col("Order_Date").cast("string")
    # asked before dates are read: a row has a date, read or as it came, exactly if one was given
    feed = feed.filter(given.isNotNull() & column("Store Code").isNotNull() & F.col("OrderNo").isNotNull())
    plain = flow_date(slashed(given))
    day = F.coalesce(plain, any_date(F.split(F.trim(given), "[ T]")[0]), any_date(given))
    text = F.coalesce(F.when(plain.isNotNull(), slashed(given)), F.date_format(_DAY, FLOW_FORMAT), slashed(given))
    feed = feed.withColumn(_DAY, day).withColumn("Order_Date", text)
    if "Email" in feed.columns:
        feed = feed.withColumnRenamed("Email", FEED_EMAIL)
    # taken before the join, so that columns nobody reads need not meet it
    feed = feed.withColumn(_ROW, F.struct(*row_values(feed, [c for c in feed.columns if c not in ("Store Code", "OrderNo")])))
    feed = feed.withColumns({d: F.xxhash64(F.lit(0), _ROW, F.lit(m), F.lit(False)) for m, d in _DIGESTS.items()}).drop(_ROW)
    served = served_days(F.col(FEED_DATE), days, trailing)
    near = feed.withColumns({_FIRST: F.element_at(served, 1), _LAST: F.element_at(served, -1)}).withColumn(
        _BLOCK, F.explode(F.sequence(_span(F.col(_FIRST)), _span(F.col(_LAST)))))
    same = [F.col(_ASKED_STORE) == column("Store Code"), F.col(_ASKED_NUMBER) == F.col("OrderNo"), F.col(_ASKED_BLOCK) == F.col(_BLOCK),
            F.col(_SERVED).between(F.col(_FIRST), F.col(_LAST))]
    rows = (near.join(asked_keys(orders), same).drop(_ASKED_STORE, _ASKED_NUMBER, _ASKED_BLOCK, _FIRST, _LAST)
            .withColumn(MATCH, F.when(F.col(_DAY) == F.col(_SERVED), SAME_DAY).otherwise(OTHER_DAY)))
    time = [column("Order Time").asc_nulls_last()] if "Order Time" in feed.columns else []
    digest = F.when(F.col(MATCH) == SAME_DAY, F.col(_DIGESTS[SAME_DAY])).otherwise(F.col(_DIGESTS[OTHER_DAY]))
    preference = [(F.col(MATCH) == SAME_DAY).desc(), F.abs(F.datediff(F.col(_DAY), F.col(_SERVED))).asc_nulls_last(),
                  F.col(_DAY).desc_nulls_last(), *time, digest]
    # the span follows from the day; named as a key, the rows stay where the join has put them
    key = Window.partitionBy(column("Store Code"), "OrderNo", _BLOCK, _SERVED).orderBy(*preference)
    best = rows.withColumn(_RANK, F.row_number().over(key)).filter(F.col(_RANK) == 1)
    return best.drop(_DAY, _BLOCK, _RANK, *_DIGESTS.values())


def match_feed(orders: DataFrame, feed: DataFrame, days: int = FEED_WINDOW_DAYS,
               trailing: bool = True) -> DataFrame:
    """All orders, with the columns of their best feed row and how it matched.

    Orders without a web order number or without a feed row keep nulls, so no
    order is lost when the feed of a day is missing. Orders without a number take
    no part in the join. Each other order meets at most one feed row per key, chosen
    before the join, so no pairs are multiplied. ``orders`` is read more than once, so
    give it a written table.
    """
    best = best_feed_rows(orders, feed, days, trailing)
    keyed = best.withColumns({_STORE: column("Store Code"), _NUMBER: F.col("OrderNo")})
    number = F.col("Enriched_WebOrder_No")
    left = orders.filter(number.isNotNull()).withColumns({_STORE: F.col("StoreCode"), _NUMBER: number, _SERVED: flow_date(F.col("InvoiceDate"))})
    web = lookup_join(left, keyed, [_STORE, _NUMBER, _SERVED], spread="Header_Id").drop(_STORE, _NUMBER, _SERVED)
    return web.unionByName(orders.filter(number.isNull()), allowMissingColumns=True)


def split_match(matched: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matched web orders, unmatched web orders and orders without a web number."""
    web = F.col("Enriched_WebOrder_No").isNotNull()
    hit = F.col(MATCH).isNotNull()
    return matched.filter(hit), matched.filter(web & ~hit), matched.filter(~web)


def recombine(parts: Sequence[DataFrame], key: str = "Header_Id") -> DataFrame:
    """Union of order sets, missing columns null, one row per key."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return dedupe_rare(union, [key])


def invoice_days(orders: DataFrame) -> DataFrame:
    """Distinct invoice days with the feed days each looks at, as text."""
    days = orders.select("InvoiceDate").distinct()
    return days.withColumn("feed_day", F.explode(window_days(flow_date(F.col("InvoiceDate"))))) \
        .withColumn("feed_day", F.date_format("feed_day", FLOW_FORMAT))
