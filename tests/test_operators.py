"""Operators on small tables, and rules that hold for every input."""

from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from orderflow import contract as C
from orderflow.operators import channels, dedupe, feed, lines, quality, shape, state
from orderflow.sources import readers, writers
from orderflow.sources.scratch import new_folder, shared_folder, staged


def test_conform_matches_names_without_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "OrderId int, `Order Type` int, Enriched_Order_Time int")
    got = shape.conform(df, {"OrderId": "Receipt_No", "Order Type": "Kind"}, ["Kind", "Receipt_No", "Enriched_order_Time"])
    assert got.columns == ["Kind", "Receipt_No", "Enriched_order_Time"] and tuple(got.first()) == (2, 1, 3)


def test_conform_reports_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "OrderId int")
    with pytest.raises(ValueError, match="Gone, OrderId"):
        shape.conform(df, {"OrderId": "Receipt_No"}, ["Receipt_No", "Gone", "OrderId"])


def test_untyped_to_text(spark):
    got = shape.untyped_to_text(spark.range(1).withColumn("x", F.lit(None)))
    assert dict(got.dtypes)["x"] == "string"


def test_split_mandatory_conserves_rows(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, None, None)], "id int, x string, y string")
    clean, rejects = quality.split_mandatory(df, ["x", "y"])
    assert [r.id for r in clean.collect()] == [1]
    assert values(rejects, "id", "reject_reason") == [(2, "missing:x"), (3, "missing:x,y")]


@pytest.mark.parametrize("spread", [None, "id"])
def test_key_filters(spark, spread):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, k string")
    stored = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    assert values(dedupe.without_keys(df, stored, ["k"], spread), "id") == [(2,), (4,)]
    assert values(dedupe.with_keys(df, stored, ["k"], spread), "id") == [(1,), (3,)]


def test_dedupe_of_bare_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert values(dedupe.dedupe_by(df, ["k"])) == [("a",), ("b",)]


FEED = "`Store Code` string, OrderNo string, Order_Date string, `Order Time` string, Email string, feed_date string"


def feed_frame(spark, rows):
    return spark.createDataFrame([(s, n, d, t, None, f) for s, n, d, t, f in rows], FEED) \
        .withColumn("feed_date", F.col("feed_date").cast("date"))


def order_frame(spark, rows):
    return spark.createDataFrame(rows, "Header_Id string, StoreCode string, InvoiceDate string, Enriched_WebOrder_No string")


def matched(spark, orders, rows, **options):
    got = feed.match_feed(order_frame(spark, orders), feed_frame(spark, rows), **options)
    return {r["Header_Id"]: (r[feed.MATCH], r["Order_Date"], r["Order Time"]) for r in got.collect()}


def test_match_prefers_same_day_then_nearest(spark):
    orders = [("h1", "S1", "2024/03/05", "1"), ("h2", "S1", "2024/03/05", "2"), ("h3", "S1", "2024/03/05", "3"),
              ("h4", "S1", "2024/03/05", None), ("h5", "S2", "2024/03/05", "1"), ("h6", "S1", "2024/03/07", "1")]
    rows = [("S1", "1", "2024-03-04", "10:00:00", "2024-03-04"), ("S1", "1", "2024/03/05", "12:00:00", "2024-03-05"),
            ("S1", "1", "2024-03-05", "11:00:00", "2024-03-05"), ("S1", "2", "2024-03-03", "1", "2024-03-03"),
            ("S1", "2", "2024-03-04", "2", "2024-03-04"), ("S1", "3", "2024-03-05", "3", "2024-03-02"),
            ("S1", "3", None, "4", "2024-03-05")]
    assert matched(spark, orders, rows) == {
        "h1": ("same_day", "2024/03/05", "11:00:00"), "h2": ("other_day", "2024/03/04", "2"), "h3": (None, None, None),
        "h4": (None, None, None), "h5": (None, None, None), "h6": ("other_day", "2024/03/05", "11:00:00")}


def test_match_window_is_on_the_folder_day(spark):
    orders = [("h", "S", "2024/03/05", "1")]
    late = [("S", "1", "2024-03-05", "1", "2024-03-07")]
    assert matched(spark, orders, late)["h"][0] is None
    assert matched(spark, orders, late, trailing=False)["h"][0] == "same_day"
    assert matched(spark, orders, [("S", "1", "2020-01-01", "1", "2024-03-03")])["h"][0] == "other_day"
    assert matched(spark, orders, [("S", "1", "2024-03-05", "1", "2024-03-02")])["h"][0] is None


def test_match_reads_other_spellings_of_dates(spark):
    orders = [(f"h{n}", "S1", "2024/03/05", n) for n in "12345"]
    rows = [("S1", "1", "2024-3-4", "a", "2024-03-05"), ("S1", "2", "05-03-2024", "b", "2024-03-05"),
            ("S1", "3", "2024-03-05 10:00:00", "c", "2024-03-05"), ("S1", "4", "soon", "d", "2024-03-05"),
            ("S1", "5", "soon", "e", "2024-03-05"), ("S1", "5", "2024-03-01", "f", "2024-03-05")]
    assert matched(spark, orders, rows) == {
        "h1": ("other_day", "2024/03/04", "a"), "h2": ("same_day", "2024/03/05", "b"), "h3": ("same_day", "2024/03/05", "c"),
        "h4": ("other_day", "soon", "d"), "h5": ("other_day", "2024/03/01", "f")}


def test_match_keeps_orders_without_a_feed(spark):
    orders = [("h1", "S", "2024/03/05", "1"), ("h2", "S", "2024/03/05", None)]
    got = feed.match_feed(order_frame(spark, orders), feed_frame(spark, []))
    hit, miss, till = feed.split_match(got)
    assert (hit.count(), miss.count(), till.count()) == (0, 1, 1)


def test_match_does_not_multiply_copies(spark):
    orders = [(f"h{i}", "S", "2024/03/05", "0") for i in range(300)]
    rows = [("S", "0", "2024-03-05", f"{i:05d}", "2024-03-05") for i in range(300)]
    got = matched(spark, orders, rows)
    assert len(got) == 300 and set(got.values()) == {("same_day", "2024/03/05", "00000")}


def test_window_and_served_days_agree(spark):
    day = F.lit(date(2024, 3, 5))
    for trailing in (True, False):
        looked = spark.range(1).select(feed.window_days(day, 2, trailing)).first()[0]
        assert looked == [date(2024, 3, d) for d in (range(3, 6) if trailing else range(3, 8))]
        for d in looked:
            assert date(2024, 3, 5) in spark.range(1).select(feed.served_days(F.lit(d), 2, trailing)).first()[0]


CHANNELS = "Header_Id string, WeborderNo string, Enriched_Sales_Channel string, Enriched_Order_Type string"


def channel_sides(spark):
    lookup = spark.createDataFrame([("Web", None, "1"), (" App ", "X", "2"), (None, None, "3"), ("App", "X", "9"), ("Ghost", "X", "77")],
                                   C.CHANNEL_LOOKUP_SCHEMA)
    names = spark.createDataFrame([(str(i), f"s{i}", f"c{i}", f"m{i}") for i in (1, 2, 3, 4, 9)], C.CHANNEL_DIMENSION_SCHEMA)
    exceptions = spark.createDataFrame([("Web", None, "4"), ("App", "X", "78")], C.CHANNEL_LOOKUP_SCHEMA)
    orders = spark.createDataFrame([("a", None, " Web ", None), ("b", "1", "Web", None), ("c", "1", "App", "X"), ("d", None, None, None),
                                    ("e", None, "app", "X"), ("f", None, "Unknown", "Unknown"), ("g", None, "Ghost", "X")], CHANNELS)
    return orders, lookup, names, exceptions


def ids(df):
    return {r.Header_Id: r.Channel_Id for r in df.collect()}


def test_channels(spark):
    orders, lookup, names, exceptions = channel_sides(spark)
    mapped = channels.map_channels(orders, lookup, names)
    assert ids(mapped) == {"a": "1", "b": "1", "c": "2", "d": "3", "e": None, "f": "3", "g": "77"}
    assert ids(channels.map_channels(orders, lookup, names, case_sensitive=False))["e"] == "2"
    row = mapped.filter("Header_Id = 'f'").first()
    assert row.Enriched_Sales_Channel is None and row.Enriched_Order_Type is None
    over = channels.override_channels(mapped, exceptions, names)
    assert ids(over) == {"a": "1", "b": "4", "c": "78", "d": "3", "e": None, "f": "3", "g": "77"}
    assert over.filter("Header_Id = 'c'").first().Source == "s2"
    assert ids(channels.override_channels(mapped, exceptions, names, "old"))["b"] == "1"
    assert over.count() == orders.count()


def test_unmapped_split(spark):
    orders, lookup, names, _ = channel_sides(spark)
    mapped = channels.map_channels(orders, lookup, names)
    kept, aside = channels.split_unmapped(mapped)
    assert set(ids(aside)) == {"e", "g"} and set(ids(kept)) == {"a", "b", "c", "d", "f"}
    kept, aside = channels.split_unmapped(mapped, strict_reference=True)
    assert "g" in ids(kept) and "g" in ids(aside)


def nested_orders(spark):
    item = lambda no: (None,) * 6 + (no,) + (None,) * 11
    rows = [("r1_1", "r1", "S", "2024/03/05", ([item("a"), item("b")],), ([("1", None, "Cash", "0")],)),
            ("r1_2", "r1", "S", "2024/03/06", ([item("c")],), (None,)),
            ("r1_3", "r1", "S", "2024/03/07", (None,), ([("2", None, "Card", "0"), ("3", None, "Card", "0")],)),
            ("r1_4", "r1", "S", "2024/03/08", ([item("d")],), ([],)), ("r2_1", "r2", "S", "2024/03/05", ([item("e")],), (None,))]
    items = f"struct<Items:array<{C.ITEM_FIELDS.simpleString()}>>"
    payments = f"struct<Payments:array<{C.PAYMENT_FIELDS.simpleString()}>>"
    return spark.createDataFrame(rows, f"Header_Id string, OrderId string, StoreCode string, Enriched_Order_Date string, "
                                       f"ItemDetails {items}, PaymentsDetails {payments}")


@pytest.mark.parametrize("parts", [1, 7])
def test_line_numbers_run_over_a_receipt(spark, parts):
    orders = nested_orders(spark).repartition(parts)
    got = lines.flatten_items(orders, ["Header_Id"])
    assert values(got, "ItemNo", "Line_No", "Line_Id") == [("a", 1, "r1_1_1"), ("b", 2, "r1_1_2"), ("c", 3, "r1_2_3"),
                                                          ("d", 4, "r1_4_4"), ("e", 1, "r2_1_1")]
    paid = lines.flatten_payments(orders, ["Header_Id"])
    assert values(paid, "Payment_Amount", "Line_No") == [("1", 1), ("2", 2), ("3", 3)]
    assert lines.flatten_items(orders, ["Header_Id"], outer=True).count() == 6


def customer(number, cid, first, last, valid=True, gone=False, when=""):
    return (number, cid, first, last, valid, gone, when)


def test_customer_merge(spark):
    old = spark.createDataFrame([customer("1", "A", "2024-01-01", "2024-02-01"), customer("2", "B", "2024-01-01", "2024-01-01")],
                                C.CUSTOMER_STATE_SCHEMA)
    delta = spark.createDataFrame([("X", "1", False, "2023-12-31", False, "", "h1"), ("Y", "1", False, "2024-03-01", True, "2024-03-02", "h2"),
                                   ("Z", "3", True, "2024-03-05", False, "", "h3"), ("W", "3", False, "2024-03-04", False, "", "h4")],
                                  "Customer_Id string, Encrypted_Mobile_Number string, Valid boolean, Order_Date string, "
                                  "Unsubscribed boolean, Unsubscribe_Date string, Header_Id string")
    one = customer("1", "A", "2023-12-31", "2024-03-01", False, True, "2024-03-02")
    three = customer("3", "W", "2024-03-04", "2024-03-05")
    merge = lambda s, d, **o: values(state.merge_customers(s, d, tie_break=["Header_Id"], **o))
    assert merge(old, delta) == sorted([one, three])
    full = state.merge_customers(old, delta, touched_only=False, tie_break=["Header_Id"])
    assert values(full) == sorted([one, customer("2", "B", "2024-01-01", "2024-01-01"), three])
    assert merge(full, delta, touched_only=False) == values(full)
    assert merge(old, delta.repartition(5)) == sorted([one, three])
    assert merge(old, delta, valid_rule="any")[0][4] is True


def test_mapping_merge_replaces_rows(spark):
    schema = "Header_Id string, a string, b string"
    old = spark.createDataFrame([("1", "x", "y"), ("2", "x", "y")], schema)
    new = spark.createDataFrame([("2", None, "z"), ("3", "n", None)], schema)
    assert values(state.merge_mapping(old, new)) == [("1", "x", "y"), ("2", "", "z"), ("3", "n", "")]
    assert values(state.merge_mapping(old, new, touched_only=True)) == [("2", "", "z"), ("3", "n", "")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(5).withColumn("x", F.lit("y"))
    assert values(staged(df, "t")) == values(df)


def test_feed_folders(spark):
    root = new_folder(spark, "feed")
    row = {f.name: F.lit("x").alias(f.name) for f in C.FEED_SCHEMA.fields}
    for day, franchise in (("2024/03/04", "dil"), ("2024/03/05", "dil"), ("2024/03/05b", "dil"), ("2024/03/06", "other")):
        row["Franchise"] = F.lit(franchise).alias("Franchise")
        spark.range(2).select(*row.values()).write.parquet(f"{root}/{day}")
    days = [date(2024, 3, d) for d in (3, 4, 5, 6)]
    got = readers.read_feed(spark, root, days)
    assert values(got.groupBy("feed_date").count()) == [(date(2024, 3, 4), 2), (date(2024, 3, 5), 2)]
    assert readers.read_feed(spark, root, [date(2020, 1, 1)]).count() == 0
    assert "feed_date" in readers.read_feed(spark, root, [date(2020, 1, 1)]).columns


def test_missing_orders_stop_the_run(spark):
    with pytest.raises(readers.MissingInput):
        readers.read_orders(spark, new_folder(spark, "none"))


def test_incremental_save(spark):
    path = new_folder(spark, "saved")
    df = spark.createDataFrame([("1", "2024-03-05", 1.0), ("2", "2024-03-05", 2.0), ("3", "2024-03-06", 3.0)],
                               "Header_Id string, d string, v double")
    assert values(writers.save_new_rows(df.limit(0), path, "d")) == []
    assert values(writers.save_new_rows(df.filter("v < 2"), path, "d")) == [("2024-03-05", 1, 1, 0)]
    assert values(writers.save_new_rows(df, path, "d")) == [("2024-03-05", 2, 1, 1), ("2024-03-06", 1, 1, 0)]
    assert values(writers.save_new_rows(df, path, "d")) == [("2024-03-05", 2, 0, 2), ("2024-03-06", 1, 0, 1)]
    assert values(spark.read.schema(df.schema).parquet(path), *df.columns) == values(df)


def test_put_batches(spark):
    sizes = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.accumulator(0)

    def put(batch):
        assert 0 < len(batch) <= 25
        sizes.add(1)
        rows.add(len(batch))

    writers.put_batches(spark.range(0, 103, 1, 2), put)
    assert (rows.value, sizes.value) == (103, 6)


def test_control_dates(spark):
    path = new_folder(spark, "control")
    for day in (date(2024, 3, 5), date(2024, 3, 6)):
        writers.append_control_date(spark, path, day)
    assert readers.last_load_date(spark, path).first()[0] == "2024/03/06"


def test_blocklist_text(spark):
    path = new_folder(spark, "blocked")
    spark.createDataFrame([("9999999999, 8888888888,",), (" 7777777777",)], "value string").write.text(path)
    assert values(readers.read_blocklist(spark, path)) == [("7777777777",), ("8888888888",), ("9999999999",)]
