"""Queries of what a run does around its tables: reading by need, partial state, reports, ledgers, catching up."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from orderflow.catalog import checks as K, fixtures as X
from orderflow.catalog.fixtures import Inputs
from orderflow.catalog.matching import MATCH_SQL, named_match
from orderflow.catalog.people import mapping_sides
from orderflow.catalog.registry import query, table
from orderflow.catalog.shapes import complete_orders, fresh_orders, stored_orders
from orderflow.functions import dates
from orderflow.operators import dedupe, feed, quality, shape, state
from orderflow.plans import daily
from orderflow.plans.catch_up import catch_up
from orderflow.sources import readers, writers
from orderflow.sources.keyed import PARTS, RUN, KeyedTable
from orderflow.sources.readers import conform_stores, read_feed, read_feed_table
from orderflow.sources.scratch import drop_folder, new_folder, staged

table("spelled_dates", K.plain(X.SPELLED_SQL))


@query("q_date_freeform", """
select o_orderkey, spelled, case when form < 11 then strftime(day, '%Y/%m/%d') end order_day,
 case when form >= 11 then 'bad_date' end reject_reason from spelled_dates""")
def date_freeform(x: Inputs) -> DataFrame:
    day = dates.any_date_text(F.col("spelled"))
    return x.sql(X.SPELLED_SQL).select("o_orderkey", "spelled", day.alias("order_day"), F.when(day.isNull(), "bad_date").alias("reject_reason"))


table("weekly_feed", "select * replace (cast(date_trunc('week', feed_date) as date) as feed_date) from own_feed")
table("weekly_matches", K.matches("h.inv - 2", "h.inv", feed="weekly_feed"))


def pruned_match(x: Inputs) -> DataFrame:
    """Orders matched to a feed that is a table by day; here its rows lie under the Monday of their week."""
    path = new_folder(x.spark, "weekly-feed")
    weekly = x.feed.withColumn("feed_date", F.date_trunc("week", "feed_date").cast("date"))
    weekly.hint("rebalance", F.col("feed_date")).write.partitionBy("feed_date").parquet(path)
    rows = read_feed_table(x.spark, path, date(1900, 1, 1), date(2100, 1, 1))
    return feed.match_feed(feed.with_web_order_number(fresh_orders(x)), rows)


@query("q_feed_pruned_match", MATCH_SQL.format(source="weekly_matches", condition="true"))
def feed_pruned_match(x: Inputs) -> DataFrame:
    return named_match(feed.split_match(pruned_match(x))[0])


#: Fixed value: the year whose feed folder is taken away.
ABSENT = 1995
table("yearly_feed", f"""
select * replace (cast(date_trunc('year', feed_date) as date) as feed_date) from own_feed where year(feed_date) <> {ABSENT}""")


@query("q_feed_folders", """
select OrderNo, Order_Date, strftime(feed_date, '%Y-%m-%d') feed_day from yearly_feed
where feed_date in (select cast(o_orderdate as date) - d from orders, unnest([0, 1, 2]) u(d))""")
def feed_folders(x: Inputs) -> DataFrame:
    """The feed in folders by day, here all under the first day of their year, one of which is missing."""
    path = new_folder(x.spark, "feed-folders")
    yearly = x.feed.withColumn("feed_day", F.trunc("feed_date", "year")).drop("feed_date")
    yearly.hint("rebalance", F.col("feed_day")).write.partitionBy("feed_day").parquet(f"{path}/by-day")
    _to_day_folders(x, path)
    drop_folder(x.spark, f"{path}/{ABSENT}/01/01")
    orders = x.table("orders").select(F.date_format("o_orderdate", dates.FLOW_FORMAT).alias("InvoiceDate"))
    rows = read_feed(x.spark, path, feed.feed_days(orders))
    return rows.select("OrderNo", "Order_Date", F.col("feed_date").cast("string").alias("feed_day"))


def _to_day_folders(x: Inputs, path: str) -> None:
    """Moves ``by-day/feed_day=yyyy-mm-dd`` to ``yyyy/mm/dd``, the form in which feeds arrive."""
    place = x.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(x.spark.sparkContext._jsc.hadoopConfiguration())
    for found in system.listStatus(place(f"{path}/by-day")):
        name = found.getPath().getName()
        if name.startswith("feed_day="):
            target = place(f"{path}/{name.removeprefix('feed_day=').replace('-', '/')}")
            system.mkdirs(target.getParent())
            system.rename(found.getPath(), target)


_PART = "('0x' || substr(md5({k}), 1, 8))::bigint % " + str(PARTS)
table("last_delta", "select * from mapping_delta where Header_Id in (select Header_Id from complete_orders where inv = (select max(inv) from complete_orders))")


@query("q_state_partial", f"""
select Header_Id, coalesce(Store_No, '') Store_No, coalesce(Receipt_No, '') Receipt_No, coalesce(Transaction_No, '') Transaction_No,
 coalesce(Aggregator_Id, '') Aggregator_Id, case when part in (select {_PART.format(k='Header_Id')} from last_delta) then '2024-01-02' else '2024-01-01' end run_date,
 part not in (select {_PART.format(k='Header_Id')} from last_delta) same_file
from (select *, {_PART.format(k='Header_Id')} part from (
 select * from last_delta union all select * from mapping_state where Header_Id not in (select Header_Id from last_delta)) m) p""")
def state_partial(x: Inputs) -> DataFrame:
    """The mapping of the last day folded into a state of all earlier orders; rows say which run wrote their file."""
    old, new = mapping_sides(x)
    days = complete_orders(x, nested_rows=False).select("Header_Id", "InvoiceDate")
    last = days.join(days.agg(F.max("InvoiceDate").alias("InvoiceDate")), "InvoiceDate", "left_semi")
    stored = KeyedTable(x.spark, new_folder(x.spark, "mapping-state"), "Header_Id", old.schema)
    stored.write(shape.fill_text(old), date(2024, 1, 1))
    file = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at")]
    before = staged(stored.read(places=True).select(*file).distinct(), "files-before").withColumn("found", F.lit(True))
    stored.merge(staged(new.join(last, "Header_Id", "left_semi"), "mapping-rows"), state.merge_mapping, date(2024, 1, 2))
    after = stored.read(places=True).select(*old.columns, RUN, *file).join(before, ["path", "at"], "left")
    return after.withColumn("same_file", F.col("found").isNotNull()).drop("path", "at", "found")


table("resent_orders", "select * from raw_orders union all select * from raw_orders where SaleIsReturn = 'Yes'")
_COMPLETE = "TotalOrderValue is not null and Totalorderqty is not null"


@query("q_day_report", f"""
select 'input' stage, count(*) row_count from resent_orders
union all select 'mandatory_missing', count(*) from resent_orders where not ({_COMPLETE})
union all select 'bad_date', 0
union all select 'copies', count(*) from raw_orders where SaleIsReturn = 'Yes' and {_COMPLETE}
union all select 'already_stored', count(*) from stored_orders
union all select 'same_day', count(*) from trailing_matches where match_class = 'same_day'
union all select 'other_day', count(*) from trailing_matches where match_class = 'other_day'
union all select 'unmatched', count(*) from fresh_orders where web_no is not null and o_orderkey not in (select hkey from trailing_matches)
union all select 'no_web_number', count(*) from fresh_orders where web_no is null
union all select 'unmapped', count(*) from mapped_orders where Source is null and Channel is null and Fulfilment_Mode is null""")
def day_report(x: Inputs) -> DataFrame:
    counts = quality.RunCounts()
    again = x.orders.filter(F.col("SaleIsReturn") == "Yes")
    raw = staged(daily.raw_counts(x.orders.unionByName(again), counts), "raw-orders")
    lookups = daily.Lookups(x.lookup, x.exceptions, x.dimension, staged(conform_stores(x.raw_stores), "stores"))
    repeated = daily.repeated_orders(raw)
    processed = stored_orders(daily.keyed_orders(raw, repeated)[0])
    daily.build_orders(raw, x.own_feed, processed, lookups, date(2024, 1, 2), stage=staged, counts=counts, repeated=repeated)
    daily.step_counts(counts)
    return counts.report(x.spark, daily.INPUT_STAGES)


def _changed(x: Inputs) -> DataFrame:
    """Complete orders: voided ones came twice, returned ones a second time with another status."""
    rows = x.headers
    voided = rows.filter(F.col("EntryStatus") == "Voided")
    returned = rows.filter(F.col("SaleIsReturn") == "Yes").withColumn("EntryStatus", F.lit("Corrected"))
    return daily.dated_orders(rows.unionByName(voided).unionByName(returned))[0]


table("changed_orders", f"""
select Header_Id, 1 + (EntryStatus is not distinct from 'Voided')::int + (SaleIsReturn = 'Yes')::int row_count, SaleIsReturn = 'Yes' conflicting
from complete_orders""")


@query("q_key_conflicts", "select Header_Id, row_count::bigint row_count from changed_orders where conflicting")
def key_conflicts(x: Inputs) -> DataFrame:
    return dedupe.key_conflicts(_changed(x), ["Header_Id"])


@query("q_key_ledger", """
select case when conflicting then 'conflict' when row_count > 1 then 'copies' else 'single' end kind, count(*) key_count, sum(row_count)::bigint row_count
from changed_orders group by 1""")
def key_ledger(x: Inputs) -> DataFrame:
    kind = F.when(F.col("conflicting"), "conflict").when(F.col("row_count") > 1, "copies").otherwise("single")
    return dedupe.key_ledger(_changed(x), ["Header_Id"]).groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("key_count"), F.sum("row_count").alias("row_count"))


#: Days that are still to be run in ``q_catch_up_days``.
OPEN_DAYS = 3


@query("q_catch_up_days", f"""
select strftime(d, '%Y-%m-%d') run_day, (select count(*) from orders where cast(o_orderdate as date) = d) row_count, strftime(l, '%Y/%m/%d') last_mark
from (select l, unnest(generate_series(l - {OPEN_DAYS - 1}, l, interval 1 day))::date d from (select max(cast(o_orderdate as date)) l from orders) m) r""")
def catch_up_days(x: Inputs) -> DataFrame:
    """All days up to three before the last order's are marked; the rest are run, each writing its orders."""
    control, facts = new_folder(x.spark, "control"), new_folder(x.spark, "facts")
    day = F.col("o_orderdate").cast("date")
    rows = x.table("orders").select(F.col("o_orderkey").cast("string").alias("Header_Id"), F.date_format(day, "yyyy-MM-dd").alias("Order_Date"))
    last = x.table("orders").agg(F.max(day)).first()[0]
    marked = x.table("orders").select(day.alias("day")).distinct().filter(F.col("day") <= last - timedelta(days=OPEN_DAYS))
    known = marked.unionByName(x.spark.createDataFrame([(last - timedelta(days=OPEN_DAYS),)], "day date")).distinct()
    known.select(F.date_format("day", dates.FLOW_FORMAT).alias("dates")).write.option("header", True).csv(control)

    def run(one: date) -> DataFrame:
        counts = quality.RunCounts()
        writers.write_facts(rows.filter(F.col("Order_Date") == str(one)), f"{facts}/{one}", "Order_Date", watch=lambda df: counts.watch(df, facts=None))
        return counts.report(x.spark)

    report = catch_up(x.spark, control, last, run)
    mark = readers.last_load_date(x.spark, control).first()[0]
    return report.select(F.col("run_date").cast("string").alias("run_day"), "row_count", F.lit(mark).alias("last_mark"))
