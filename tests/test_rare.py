"""Wide rows stay where they are unless their key repeats; results are those of the plain way."""

from pyspark.sql import functions as F

from orderflow.catalog import shapes
from orderflow.catalog.fixtures import Inputs
from orderflow.functions.dates import FLOW_FORMAT, SLASHED, flow_date
from orderflow.operators import dedupe, feed, lines, phones
from orderflow.sources.scratch import staged


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def values(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def rows(spark, repeated):
    """Keys of two columns, null among them; ``repeated`` of them come three times, twice with the same rest."""
    once = spark.range(200).select(F.when(F.col("id") % 20 != 0, F.col("id").cast("string")).alias("a"), F.col("id").alias("b"),
                                   F.array(F.col("id").cast("string"), F.lit(None)).alias("rest"))
    more = once.filter(F.col("b") < repeated)
    return once.unionByName(more).unionByName(more.withColumn("rest", F.array(F.lit("other"))))


def test_single_keys_are_not_sorted(spark):
    assert "Window" not in plan(dedupe.dedupe_rare(rows(spark, 0), ["a", "b"]))
    assert "Window" in plan(dedupe.dedupe_rare(rows(spark, 5), ["a", "b"]))


def test_rare_and_many_repeats_keep_the_same_rows(spark):
    df = rows(spark, 30)
    want = values(dedupe.dedupe_by(df, ["a", "b"]))
    assert len(want) == 200
    for rare in (0, 29, 30, 1000):
        assert values(dedupe.dedupe_rare(df, ["a", "b"], rare=rare)) == want


def test_line_starts_sort_shared_receipts_only(spark):
    orders = spark.range(60).select(F.col("id").cast("string").alias("Header_Id"), F.lit("S1").alias("StoreCode"),
                                    F.format_string("2024/01/%02d", F.col("id") % 3 + 1).alias("Enriched_Order_Date"),
                                    F.when(F.col("id") < 6, F.floor(F.col("id") / 3)).otherwise(F.col("id")).cast("string").alias("OrderId"),
                                    F.col("id").cast("int").alias(lines.ITEM_COUNT), F.lit(2).alias(lines.PAYMENT_COUNT))
    got = {r.Header_Id: (r[lines.ITEM_START], r[lines.PAYMENT_START]) for r in lines.with_line_starts(orders).collect()}
    assert [got[str(i)] for i in range(6)] == [(0, 0), (0, 2), (1, 4), (0, 0), (3, 2), (7, 4)]
    assert len(got) == 60 and all(got[str(i)] == (0, 0) for i in range(6, 60))
    assert "Window" not in plan(lines.with_line_starts(orders.filter("OrderId > '5'")))


def test_daily_counts_of_one_are_not_looked_up(spark):
    orders = spark.createDataFrame([("1", None, "d"), ("2", None, "d"), ("3", "7", "d"), ("4", "7", "d"), ("5", "8", "d"), ("6", "7", None)],
                                   f"Header_Id string, {phones.RAW_PHONE} string, InvoiceDate string")
    want = {"1": 2, "2": 2, "3": 2, "4": 2, "5": 1, "6": 1}
    for rare in (0, 100):
        assert {r.Header_Id: r[phones.DAILY] for r in phones.with_daily_count(orders, rare=rare).collect()} == want


def test_feed_rows_without_an_order_are_left_before_they_are_ranked(spark):
    orders = spark.createDataFrame([("S1", "10", "2024/03/04"), ("S1", None, "2024/03/04")], "StoreCode string, Enriched_WebOrder_No string, InvoiceDate string")
    sent = spark.createDataFrame([("S1", "10", "2024-03-03"), ("S1", "10", "2024-03-04"), ("S1", "11", "2024-03-04"), ("S2", "10", "2024-03-04"), ("S1", "10", "2024-02-01")],
                                 "`Store Code` string, OrderNo string, Order_Date string").withColumn("feed_date", F.to_date("Order_Date"))
    (best,) = feed.best_feed_rows(orders, sent).collect()
    assert (best["Store Code"], best.OrderNo, best.Order_Date, best[feed.MATCH]) == ("S1", "10", "2024/03/04", feed.SAME_DAY)


def test_feed_spans_meet_over_their_edges(spark):
    """Feed days around the first day of a span, looked at from both sides of it."""
    days = F.explode(F.sequence(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-07-31"))))
    orders = spark.range(1).select(days.alias("d")).select(F.lit("S").alias("StoreCode"), F.date_format("d", "yyyy/MM/dd").alias("InvoiceDate"),
                                                           F.dayofyear("d").cast("string").alias("Enriched_WebOrder_No"))
    for move in (-2, 0, 2):
        sent = orders.select(F.col("StoreCode").alias("Store Code"), F.col("Enriched_WebOrder_No").alias("OrderNo"),
                             F.date_add(F.to_date("InvoiceDate", "yyyy/MM/dd"), move).alias("feed_date")).withColumn("Order_Date", F.col("feed_date").cast("string"))
        assert feed.best_feed_rows(orders, sent, trailing=False).count() == orders.count()
        assert feed.best_feed_rows(orders, sent).count() == (0 if move > 0 else orders.count())


def test_wanted_columns_are_kept_of_the_same_rows(spark):
    df = rows(spark, 30).withColumn("more", F.to_json("rest"))
    want = values(dedupe.dedupe_by(df, ["a", "b"]).select("a", "b", "more"))
    for rare in (0, 29, 30, 1000):
        assert values(dedupe.dedupe_rare(df, ["a", "b"], rare=rare, kept=staged(df.select("a", "b", "more"), "kept"))) == want
    once = rows(spark, 0)
    assert "Range" not in plan(dedupe.dedupe_rare(once, ["a", "b"], kept=staged(once.select("a", "b"), "kept")))


def test_orders_meet_stored_keys_with_the_columns_that_matching_reads(spark, data):
    x = Inputs(spark, data)
    got = shapes.fresh_orders(x)
    assert got.columns == shapes.MATCH_COLUMNS
    assert shapes.fresh_orders(x, "OrderSource").columns == [*shapes.MATCH_COLUMNS, "OrderSource"]
    complete = shapes.complete_orders(x, nested_rows=False).filter("cast(OrderId as bigint) % 10 <> 0")
    assert values(got) == values(complete.select(*shapes.MATCH_COLUMNS))


def ties(spark):
    """Feed rows that differ in nothing that the preference names."""
    orders = spark.createDataFrame([("S", str(n), f"2024/03/0{d}") for n in range(20) for d in (4, 5)], "StoreCode string, Enriched_WebOrder_No string, InvoiceDate string")
    sent = spark.range(200).select(F.lit("S").alias("Store Code"), (F.col("id") % 20).cast("string").alias("OrderNo"), F.lit("2024-03-04").alias("Order_Date"),
                                   F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("Reference No"), F.lit(1).alias("n"))
    return orders, sent.withColumn("feed_date", F.to_date("Order_Date"))


def test_feed_ties_go_by_the_digest_of_the_row(spark):
    orders, sent = ties(spark)
    told = sent.withColumns({"Order_Date": F.lit("2024/03/04"), "_order_day": F.col("feed_date")})
    rest = ["Order_Date", "Reference No", "n", "feed_date", "_order_day"]
    want = {}
    for served, kind in (("04", feed.SAME_DAY), ("05", feed.OTHER_DAY)):
        marked = told.withColumn(feed.MATCH, F.lit(kind))
        for r in marked.withColumn("d", dedupe.row_digest(marked, [*rest, feed.MATCH])[0]).orderBy(F.col("d").desc()).collect():
            want[served, r.OrderNo] = r["Reference No"]
    for parts in (1, 7):
        best = feed.best_feed_rows(orders, sent.repartition(parts)).collect()
        assert {(f"{r._served:%d}", r.OrderNo): r["Reference No"] for r in best} == want


def test_feed_rows_carry_one_number_for_each_kind_of_match(spark):
    orders, sent = ties(spark)
    assert plan(feed.best_feed_rows(orders, sent)).count("xxhash64") == 2


def test_flow_dates_are_cast(spark):
    texts = ["2024/02/29", "2023/02/29", "0000/01/01", "9999/12/31", "2024/13/01", "2024/1/01", "2024-01-01", "2024/01/01\n", " 2024/01/01", "2024/01/01 ", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(F.col("t").rlike(SLASHED), F.try_to_timestamp("t", F.lit(FLOW_FORMAT)).cast("date"))
    got = df.select(flow_date(F.col("t")).cast("string").alias("got"), plain.cast("string").alias("want"), "t")
    assert all(r.got == r.want for r in got.collect()) and got.filter("got is not null").count() == 3
    assert "gettimestamp" not in plan(got.drop("want")).lower()
