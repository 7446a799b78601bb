"""The daily run from XML to its outputs, and a second run on top of it."""

import os
from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from orderflow import contract as C
from orderflow.plans import daily
from orderflow.plans.catch_up import catch_up, stored_mark
from orderflow.sources import readers
from orderflow.sources.scratch import new_folder

KEY, IV = "0123456789abcdef0123456789abcdef", "abcdefghijklmnop"
STATES = ("customers", "order_pii", "mapping")


def element(name, value):
    return f"<{name}/>" if value is None else f"<{name}>{value}</{name}>"


def order(number, day="03/05/24", items=(), payments=(), **fields):
    values_ = {"OrderId": number, "TransactionNo": f"T{number}", "StoreCode": "S1", "InvoiceDate": day, "InvoiceTime": "01:02:03 PM",
               "Totalorderqty": "-2.00", "TotalOrderValue": "-1,100.50", "NetAmount": "-1,000.50", "SGST": "-50.00", "CGST": "-50.00",
               "Totaldiscount": "0", "OrderSource": "Web", "OrderType": "Delivery", "PhoneNo": "09876543210"} | fields
    body = "".join(element(k, v) for k, v in values_.items())
    if items is not None:
        body += "<ItemDetails>" + "".join("<Items>" + "".join(element(k, v) for k, v in i.items()) + "</Items>" for i in items) + "</ItemDetails>"
    body += "<PaymentsDetails>" + "".join("<Payments>" + "".join(element(k, v) for k, v in p.items()) + "</Payments>" for p in payments) \
        + "</PaymentsDetails>"
    return f'<{C.ORDER_ROW_TAG} version="1">{body}</{C.ORDER_ROW_TAG}>'


ITEMS = [{"ItemNo": "p1", "ItemCatagory": "PIZZA", "Promono": None, "ProductGroup": "G", "Quantity": "-1", "NetAmount": "-10", "SGST": "-1",
          "CGST": "-1", "FoodType": "Non Veg"},
         {"ItemNo": "t1", "ItemCatagory": "TOPPING", "Promono": "D1", "ProductGroup": "H", "Quantity": "-2.00", "NetAmount": "-1,234.50"}]
PAYMENTS = [{"Amount": "1,000.00", "Date": "03/05/24", "Mode": "Gift Card", "TenderType": "3"}, {"Amount": "0.5", "Mode": "Cash"}]
FIRST = order("1", items=ITEMS, payments=PAYMENTS, WeborderNo="W1P", Email="a@example.com")
ORDERS = [FIRST, FIRST, order("2", day="2024-03-05", items=ITEMS[1:], InvoiceTime=None), order("3", day="05-03-2024", items=None, OrderSource="None"),
          order("4", items=ITEMS, NetAmount=None), order("5", day="99-99-99", items=ITEMS),
          order("6", items=ITEMS[:1], payments=PAYMENTS[1:], EntryStatus="Voided", InvoiceTime="23:59:58", StoreCode="S2", PhoneNo=None)]


@pytest.fixture(scope="module")
def lookups(spark):
    channels = spark.createDataFrame([("Web", "Delivery", "1"), ("App", "Delivery", "2")], C.CHANNEL_LOOKUP_SCHEMA)
    exceptions = spark.createDataFrame([("App", "Delivery", "3")], C.CHANNEL_LOOKUP_SCHEMA)
    names = spark.createDataFrame([(str(i), f"src{i}", f"ch{i}", f"mode{i}") for i in (1, 2, 3)], C.CHANNEL_DIMENSION_SCHEMA)
    stores = spark.createDataFrame([("owner", "c", "town", "st", "z", "cl", "f", "l", "t", "r", "S1")], ", ".join(f"{c} string" for c in C.STORE_COLUMNS))
    return daily.Lookups(channels, exceptions, names, readers.conform_stores(stores))


@pytest.fixture(scope="module")
def feed(spark):
    row = {f.name: None for f in C.FEED_SCHEMA.fields} | {
        "Store Code": "S1", "OrderNo": "W1", "Order_Date": "2024-03-04", "Order Time": "11:59:00 PM", "Franchise": "dil", "MobileNo": "8000000001",
        "Pasta by PH": "PH 1", "New_Channel": "App", "Aggregator Order ID": " "}
    rows = spark.createDataFrame([tuple(row.values())], C.FEED_SCHEMA)
    return rows.withColumn(C.FEED_DATE, F.lit("2024-03-04").cast("date"))


def run(spark, lookups, feed, orders, day, root):
    path = new_folder(spark, "xml")
    spark.createDataFrame([("<Orders>" + "".join(orders) + "</Orders>",)], "value string").write.text(path)
    raw = readers.read_orders(spark, path)
    report = daily.run_day(spark, raw, feed, lookups, day, f"{root}/out", f"{root}/state", KEY, IV, parts=4)
    return {r.stage: r.row_count for r in report.collect()}


def tables(spark, root):
    schema = spark.read.parquet(f"{root}/state/order_pii").drop("run_date", "key_part").schema
    return daily.state_tables(spark, f"{root}/state", schema, parts=4)


@pytest.fixture(scope="module")
def first_run(spark, lookups, feed):
    root = new_folder(spark, "run")
    return root, run(spark, lookups, feed, ORDERS, date(2024, 3, 6), root)


def test_counts_add_up(first_run):
    _, counts = first_run
    steps = {n: counts[n] for n in daily.INPUT_STAGES}
    assert steps == {"input": 7, "mandatory_missing": 1, "bad_date": 1, "copies": 1, "already_stored": 0, "same_day": 0, "other_day": 1,
                     "unmatched": 0, "no_web_number": 3, "unmapped": 1}
    assert steps["input"] == sum(n for name, n in steps.items() if name not in ("input", "unmapped"))
    parts = {n: counts.pop(f"{n}_parts") for n in STATES}
    assert all(1 <= n <= 3 for n in parts.values())
    assert {n: c for n, c in counts.items() if n not in steps} == {
        "baseline": 3, "line": 4, "payment": 3, "rejects_mandatory_missing": 1, "rejects_bad_date": 1, "rejects_unmapped_channel": 1,
        "key_conflicts": 0, "customers": 3, "order_pii": 3, "mapping": 3, "processed": 3}


def test_baseline(spark, first_run):
    rows = spark.read.parquet(f"{first_run[0]}/out/2024/03/06/BASELINE")
    assert rows.columns == C.BASELINE_COLUMNS + C.BASELINE_PLACEHOLDERS + ["partition_date"]
    one, two, six = (r.asDict() for r in rows.orderBy("Header_Id").collect())
    want = {"Header_Id": "1_20240305_S1", "Enriched_Order_Date": "2024-03-04", "Invoice_Open_Date": "2024-03-05", "Enriched_Order_Time": "23:59:00",
            "Channel_Id": "3", "Source": "src3", "Enriched_Sales_Channel": "App", "Enriched_Order_Type": "Delivery", "Net_Amount": 1000.5,
            "Gross_Amount": 1100.5, "Tax_Amount": 100.0, "Discount_Amount": 0.0, "Order_Quantity": 2, "Payment_Mode": "Gift Card, Cash",
            "Gift_Card": True, "Gift_Card_Amount": 1000.0, "Deal": True, "Ala_Carte": True, "Non_Veg": True, "Year": 2024, "Month": 3,
            "Week_Day": 1, "Week_Number": 10, "Hour_Day_Part": 23, "Day_Part": "Late night", "Enriched_WebOrderNo": "W1", "Franchise": "DIL",
            "PHDV_Pizzahut_Brand": "PizzaHut", "StoreMaster_Franchise": "owner", "System_Processed_Date": "2024-03-06", "Valid_Transaction": True,
            "GES_Code": None}
    assert {k: one[k] for k in want} == want
    want = {"Header_Id": "2_20240305_S1", "Enriched_Order_Time": "23:59:00", "Channel_Id": "1", "Payment_Mode": None, "Gift_Card": None,
            "Deal": True, "Ala_Carte": False, "Non_Veg": False, "Franchise": "DIL", "Enriched_WebOrderNo": None}
    assert {k: two[k] for k in want} == want
    assert (six["Valid_Transaction"], six["StoreMaster_Franchise"], six["Payment_Mode"], six["Gift_Card"]) == (False, None, "Cash", False)


def test_lines_and_payments(spark, first_run):
    root = f"{first_run[0]}/out/2024/03/06"
    lines = spark.read.parquet(f"{root}/LINE")
    assert lines.columns == C.LINE_COLUMNS + C.LINE_PLACEHOLDERS + ["partition_date"]
    assert values(lines, "Line_Id", "Item_No", "Parent_ID", "Base", "Quantity", "Line_Net_Amount", "Tax_Amount") == [
        ("1_20240305_S1_1", "p1", None, "G", 1, 10.0, 2.0), ("1_20240305_S1_2", "t1", "p1", None, 2, 1234.5, None),
        ("2_20240305_S1_1", "t1", None, None, 2, 1234.5, None), ("6_20240305_S2_1", "p1", None, "G", 1, 10.0, 2.0)]
    payments = spark.read.parquet(f"{root}/PAYMENT")
    assert payments.columns == C.PAYMENT_COLUMNS + C.PAYMENT_PLACEHOLDERS + ["partition_date"]
    assert values(payments, "Payment_Id", "Tender_Name", "Gross", "Tender_date", "Invoice_Open_Date") == [
        ("1_20240305_S1_1", "Gift Card", 1000.0, "2024-03-05", "2024-03-04"), ("1_20240305_S1_2", "Cash", 0.5, None, "2024-03-04"),
        ("6_20240305_S2_1", "Cash", 0.5, None, "2024-03-05")]


def test_rejects_name_their_reason(spark, first_run):
    root = f"{first_run[0]}/out/2024/03/06/REJECTS"
    reasons = {r: values(spark.read.parquet(f"{root}/{r}"), "OrderId", "reject_reason") for r in ("mandatory_missing", "bad_date", "unmapped_channel")}
    assert reasons == {"mandatory_missing": [("4", "missing:NetAmount")], "bad_date": [("5", "bad_date:InvoiceDate")],
                       "unmapped_channel": [("3", "unmapped_channel")]}


def test_states(spark, first_run):
    from orderflow.functions.privacy import decrypt
    found = tables(spark, first_run[0])
    customers = found["customers"].read(date(2024, 3, 7))
    assert customers.schema.names == C.CUSTOMER_STATE_SCHEMA.fieldNames()
    shown = customers.select(decrypt(F.col("Mobile_Number"), KEY, IV), "First_Order_Date", "Last_Order_Date", "Valid")
    assert values(shown) == [("8000000001", "2024-03-04", "2024-03-04", True), ("9876543210", "2024-03-05", "2024-03-05", True),
                             ("xxxxxxxxxx", "2024-03-05", "2024-03-05", False)]
    pii = found["order_pii"].read(date(2024, 3, 7))
    assert pii.columns == [C.PII_STATE_RENAMES.get(c, c) for c in C.PII_COLUMNS]
    assert pii.filter("Email = 'a@example.com' or Mobile_Number like '%9876543210%'").count() == 0
    mapping = found["mapping"].read(date(2024, 3, 7))
    assert mapping.columns == C.MAPPING_STATE_SCHEMA.fieldNames()
    assert values(mapping, "Header_Id", "Aggregator_Id", "Online_ref_ID")[0] == ("1_20240305_S1", "  ", "W1")
    joined = mapping.join(customers, "Customer_Id").count()
    assert joined == 3


def test_second_run_skips_stored_orders(spark, lookups, feed, first_run):
    root = first_run[0]
    more = ORDERS + [order("7", items=ITEMS, day="March 6, 2024")]
    counts = run(spark, lookups, feed, more, date(2024, 3, 7), root)
    assert counts["baseline"] == 1 and counts["line"] == 2 and counts["already_stored"] == 3 and counts["processed"] == 1
    assert counts["customers_parts"] == counts["mapping_parts"] == 1
    found = tables(spark, root)
    assert found["customers"].read().count() == 3 and found["mapping"].read().count() == 4
    assert {r[0] for r in found["mapping"].read(places=True).select("run_date").distinct().collect()} <= {"2024-03-06", "2024-03-07"}
    again = run(spark, lookups, feed, more, date(2024, 3, 7), root)
    assert again == counts and found["mapping"].read().count() == 4
    nothing = run(spark, lookups, feed, ORDERS, date(2024, 3, 8), root)
    assert nothing["baseline"] == 0 and nothing["customers_parts"] == 0 and found["customers"].read().count() == 3


def test_a_repeated_run_does_not_see_itself(spark, lookups, feed, first_run):
    root, counts = first_run
    again = run(spark, lookups, feed, ORDERS, date(2024, 3, 6), root)
    assert again["baseline"] == 3 and again["already_stored"] == 0
    assert tables(spark, root)["mapping"].read(date(2024, 3, 7)).count() == 3


def test_working_tables_go(spark, lookups, feed, monkeypatch):
    root = new_folder(spark, "released")
    there = lambda: {p for p in os.listdir(os.path.dirname(root)) if not p.startswith(("xml", "released"))}
    before = there()
    assert run(spark, lookups, feed, ORDERS, date(2024, 3, 6), root)["baseline"] == 3 and there() == before
    monkeypatch.setattr(daily, "payment_facts", lambda orders: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, lookups, feed, ORDERS, date(2024, 3, 6), f"{root}/other")
    assert there() == before


def test_feed_folders_of_the_orders_days(spark, lookups, feed):
    root = new_folder(spark, "folders")
    feed.drop(C.FEED_DATE).write.parquet(f"{root}/feed/2024/03/04")
    feed.drop(C.FEED_DATE).write.parquet(f"{root}/feed/2024/02/04")  # no order looks at it
    counts = run(spark, lookups, f"{root}/feed", ORDERS, date(2024, 3, 6), root)
    assert counts["other_day"] == 1 and counts["unmatched"] == 0
    assert run(spark, lookups, f"{root}/no-feed", ORDERS, date(2024, 3, 6), f"{root}/b")["unmatched"] == 1


def test_different_rows_under_a_key_are_listed(spark, lookups, feed):
    root = new_folder(spark, "conflicts")
    counts = run(spark, lookups, feed, ORDERS + [order("6", items=ITEMS, StoreCode="S2")], date(2024, 3, 6), root)
    assert counts["key_conflicts"] == 1 and counts["copies"] == 2 and counts["baseline"] == 3
    assert values(spark.read.parquet(f"{root}/out/2024/03/06/REJECTS/key_conflicts")) == [("6_20240305_S2", 2, "different_rows")]


def test_catching_up_stops_at_a_failure(spark, lookups, feed):
    root = new_folder(spark, "catch-up")
    control, ran = f"{root}/control", []
    orders = {date(2024, 3, 6): ORDERS, date(2024, 3, 7): [order("8", items=ITEMS)], date(2024, 3, 8): [order("9", items=ITEMS, day="7th of March 2024")]}

    def one(day, broken=date(2024, 3, 7)):
        ran.append(day)
        if day == broken:
            raise OSError("no orders yet")
        path = new_folder(spark, "xml")
        spark.createDataFrame([("<Orders>" + "".join(orders[day]) + "</Orders>",)], "value string").write.text(path)
        return daily.run_day(spark, readers.read_orders(spark, path), feed, lookups, day, f"{root}/out", f"{root}/state", KEY, IV, parts=4)

    with pytest.raises(ValueError):
        catch_up(spark, control, date(2024, 3, 8), one)
    with pytest.raises(OSError):
        catch_up(spark, control, date(2024, 3, 8), one, first=date(2024, 3, 6))
    assert ran == [date(2024, 3, 6), date(2024, 3, 7)] and stored_mark(spark, control) == date(2024, 3, 6)
    report = catch_up(spark, control, date(2024, 3, 8), lambda day: one(day, None))
    assert ran[2:] == [date(2024, 3, 7), date(2024, 3, 8)] and stored_mark(spark, control) == date(2024, 3, 8)
    assert values(report.filter("stage = 'baseline'"), "run_date", "row_count") == [(date(2024, 3, 7), 1), (date(2024, 3, 8), 1)]
    assert tables(spark, root)["mapping"].read().count() == 5
    assert catch_up(spark, control, date(2024, 3, 8), one).count() == 0 and len(ran) == 4
