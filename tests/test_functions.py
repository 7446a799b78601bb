"""Expression tables: inputs with the results read off the rules."""

import hashlib
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from orderflow.functions import amounts, codes, dates, nested, phones, privacy, times
from orderflow.plans.session import register_functions

KEY, IV = "0123456789abcdef0123456789abcdef", "abcdefghijklmnop"


def outcome(spark, pairs, build, schema="v string"):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], f"i int, {schema}")
    got = {r.i: r.out for r in rows.select("i", build(F.col("v")).alias("out")).collect()}
    return [got[i] for i in range(len(pairs))]


def check(spark, pairs, build, schema="v string"):
    assert outcome(spark, pairs, build, schema) == [b for _, b in pairs]


def test_amount(spark):
    check(spark, [("-1,234.50", 1234.5), ("0", 0.0), ("", None), ("abc", None), (None, None), ("12", -12.0),
                  ("-1,000,000.25", 1000000.25)], amounts.amount)
    check(spark, [("1,234.50", 1234.5), ("-2", -2.0)], lambda c: amounts.amount(c, negate=False))


def test_amount_of_zero_has_no_sign(spark):
    assert str(outcome(spark, [("0", 0.0)], amounts.amount)[0]) == "0.0"


def test_quantity(spark):
    check(spark, [("-2.00", 2), ("1,002", 1002), ("-3", 3), ("2.9", 2), ("", None), ("x", None), (None, None),
                  ("99999999999", None)], amounts.quantity)


def test_any_date(spark):
    check(spark, [("05-03-24", "2024/03/05"), ("05-03-2024", "2024/03/05"), ("03/05/24", "2024/03/05"),
                  ("03/05/2024", "2024/03/05"), ("2024-03-05", "2024/03/05"), ("2024/03/05", "2024/03/05"),
                  ("5-3-2024", "2024/03/05"), ("03/05/75", "1975/03/05"), ("03/05/68", "2068/03/05"),
                  ("03/05/69", "1969/03/05"), ("29-02-72", "1972/02/29"), ("31/13/24", None), ("30-02-2024", None),
                  ("", None), (None, None), ("soon", None)], dates.any_date_text)


def test_free_form_dates(spark):
    same = ["5th of March 2024", "Tue, Mar 5 24 10:11 pm", "2024.03.05T10:11Z", "20240305", "March 5, 2024", "5 Mar 2024", "05-Mar-24",
            "Mar-05-2024", "2024 March 5", "2024-03-05T10:11:12+05:30", "3.5.2024", "5mar2024", "20240305101112", "2024-03-05 10:11:12.123",
            "2024/3/5 9:05 AM", "  3 / 5 / 2024 ", "Tuesday the 5th of March, 2024 at 5pm", "05 Mar 24 at 10 am", "03.05.2024 00:00:00"]
    check(spark, [(t, "2024/03/05") for t in same], dates.any_date_text)
    check(spark, [("31/12/2024", "2024/12/31"), ("13.5.24", "2024/05/13"), ("99 Feb 01", "1999/02/01"), ("Sept 9 1999", "1999/09/09"),
                  ("Feb 29, 2024", "2024/02/29"), ("1 jan 69", "1969/01/01"), ("1 jan 68", "2068/01/01"), ("may 4 may", None),
                  ("2024-13-45", None), ("99-99-99", None), ("5 Mar", None), ("24 Mar 5", None), ("Mar 2024", None), ("Monday", None), ("5 Mar 2024 junk", None),
                  ("30 Feb 2024", None), ("Feb 29, 2023", None), ("1-2-3", None), ("123 4 5", None), ("1e5 2 3", None), ("10:11", None),
                  ("5 Mar 2024 6", None), ("marchy 5 2024", None), ("2024", None), ("-5 -3 -2024-", "2024/05/03")], dates.any_date_text)


def test_date_texts(spark):
    check(spark, [("03/05/24", "2024/03/05"), ("03/05/99", "2099/03/05"), ("3/5/24", None), ("x", None), (None, None)],
          dates.short_date_text)
    check(spark, [("2024/03/05", "2024-03-05"), ("2024-03-05", None), ("2024/13/05", None), (None, None)],
          dates.output_date_text)
    check(spark, [("2024-03-05", "2024/03/05"), ("2024/03/05", "2024/03/05"), (None, None)], dates.slashed)


def test_state_dates(spark):
    check(spark, [("2024-03-05", "2024-03-05"), ("", ""), (None, ""), ("x", "")],
          lambda c: dates.state_date_text(dates.state_date(c), ""))


def test_week_number_and_day(spark):
    day = date(2019, 12, 25)
    pairs = []
    for _ in range(900):
        first = date(day.year, 1, 1)
        monday = first - timedelta(days=first.weekday())
        pairs.append((day, ((day - monday).days // 7 + 1, day.weekday() + 1)))
        day += timedelta(days=3)
    got = outcome(spark, pairs, lambda c: F.struct(dates.week_number(c), dates.week_day(c)), "v date")
    assert [tuple(g) for g in got] == [b for _, b in pairs]


def test_clock(spark):
    check(spark, [("00:00:00", "00:00:00"), ("9:5:1", "09:05:01"), ("9:5:1 pm", "21:05:01"), ("12:00:00 AM", "00:00:00"),
                  ("12:30:00 PM", "12:30:00"), (" 11:41:56 PM ", "23:41:56"), ("\t08:00:00\n", "08:00:00"),
                  ("11:41:56  PM", "23:41:56"), ("11:41:56PM", None), ("13:00:00 PM", None), ("00:10:00 AM", None),
                  ("24:00:00", None), ("10:60:00", None), ("10:00:60", None), ("10:00", None), ("", None), (None, None)],
          times.clock)


def test_seconds_round_trip(spark):
    check(spark, [("23:59:59", "00:00:01"), ("00:00:00", "00:00:02"), ("12:34:56", "12:34:58"), (None, None), ("x", None)],
          lambda c: times.clock_of_seconds(times.day_seconds(c) + 2))


def test_day_parts(spark):
    live = [("03:59:59", "Late night"), ("04:00:00", "Late night"), ("04:59:59", "Late night"), ("05:00:00", "Breakfast"),
            ("10:59:59", "Breakfast"), ("11:00:00", "Lunch"), ("14:59:59", "Lunch"), ("15:00:00", "Snack"),
            ("18:59:59", "Snack"), ("19:00:00", "Dinner"), ("22:59:59", "Dinner"), ("23:00:00", "Late night"), (None, None)]
    check(spark, live, lambda c: times.day_part(times.hour(c)))
    other = [(t, "Breakfast" if t == "04:00:00" or t == "04:59:59" else p) for t, p in live]
    check(spark, other, lambda c: times.day_part(times.hour(c), breakfast_start=4))


def test_web_order_number(spark):
    check(spark, [("12345678P", "12345678"), ("123p", "123"), ("123456780", "12345678"), ("1234567890", "1234567890"),
                  ("12345670", "12345670"), ("123456789", "123456789"), ("", ""), (None, None)], codes.web_order_number)


def test_keys(spark):
    rows = spark.createDataFrame([("1", "2024/03/05", "S1", "9", None)], "o string, d string, s string, t string, p string")
    got = rows.select(codes.header_id(F.col("o"), F.col("d"), F.col("s")),
                      codes.orderwise_id(F.col("t"), F.col("p"), F.col("s"), F.col("d"))).first()
    assert tuple(got) == ("1_20240305_S1", "9_S1_20240305")


def test_labels(spark):
    check(spark, [("PH one", "A"), ("Pasta", "B"), ("else", "else"), (None, None)],
          lambda c: codes.prefix_label(c, {"PH": "A", "Pasta": "B"}))
    check(spark, [("Voided", False), ("Posted", True), (None, True)], codes.valid_transaction)
    check(spark, [("PIZZA", "g"), ("food", "g"), ("Drink", None), (None, None)], lambda c: codes.item_base(c, F.lit("g")))
    check(spark, [("dil", "DIL"), (None, "DIL")], lambda c: codes.upper_or(c, "DIL"))
    check(spark, [(None, "  "), ("", "  "), ("   ", "  "), ("x", "x")], lambda c: codes.blank_to(c, "  "))


PHONES = [  # text, orders that day, number, valid
    (None, 1, None, False), ("", 1, "", False), ("12345", 1, "12345", False), ("123456789", 1, "123456789", False),
    ("5876543210", 1, "5876543210", False), ("6876543210", 1, "6876543210", True), ("6876543210", 3, "6876543210", True),
    ("6876543210", 4, "6876543210", False), ("09876543210", 1, "9876543210", True), ("919876543210", 1, "9876543210", True),
    ("+919876543210", 1, "9876543210", True), ("9198765432101", 1, "98765432101", True),
    ("9198765432101", 4, "9198765432101", False), (" 98765 43210 ", 1, "9876543210", True), ("\t9876543210\n", 1, "9876543210", True),
    ("9abcdefghi", 1, "9abcdefghi", True),
]


def test_phones(spark):
    rows = spark.createDataFrame([(i, t, n) for i, (t, n, _, _) in enumerate(PHONES)], "i int, t string, n int")
    cleaned = phones.clean_phone(F.col("t"))
    got = rows.select("i", phones.phone_number(cleaned, F.col("n")), phones.phone_is_valid(cleaned, F.col("n"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {i: (p[2], p[3]) for i, p in enumerate(PHONES)}


def test_phone_strict(spark):
    check(spark, [("9abcdefghi", False), ("9198765432101", False), ("6876543210", True), (None, False)],
          lambda c: phones.phone_is_valid(c, F.lit(1), strict=True))


def test_encryption_known_value(spark):
    check(spark, [("9876543210", "OBiQL8TXNOvhB+wi8sz9Pg=="), ("", ""), (None, "")], lambda c: privacy.encrypt(c, KEY, IV))


@pytest.mark.parametrize("iv", [IV, None])
def test_decryption(spark, iv):
    check(spark, [("9876543210", "9876543210"), ("naïve ✓", "naïve ✓"), ("", None), (None, None)],
          lambda c: privacy.decrypt(privacy.encrypt(c, KEY, iv), KEY, iv))
    check(spark, [("no base64!", None), ("AAAA", None), (None, None)], lambda c: privacy.decrypt(c, KEY, iv))


def test_stable_id(spark):
    text = "OBiQL8TXNOvhB+wi8sz9Pg=="
    want = str(uuid.UUID(hex=hashlib.md5(text.encode()).hexdigest()))
    check(spark, [(text, want), (None, None)], privacy.stable_id)
    register_functions(spark)
    check(spark, [(text, want), (None, None)], lambda c: F.call_function("stable_id", c))


ITEMS = "v array<struct<ItemNo:string,ItemCatagory:string,Promono:string,FoodType:string>>"


def item(no, kind, promo=None, food=None):
    return (no, kind, promo, food)


def test_item_flags(spark):
    both, promo, plain = [item("1", "PIZZA", "P"), item("2", "Food")], [item("1", "PIZZA", "P")], [item("1", "PIZZA")]
    check(spark, [(both, (True, True)), (promo, (True, False)), (plain, (False, True)), ([], (False, False)), (None, (None, None))],
          lambda c: F.struct(nested.any_with_promo(c), nested.any_without_promo(c)), ITEMS)
    check(spark, [([item("1", "x", None, "Non Veg")], True), ([item("1", "x", None, None)], False), ([], False), (None, False)],
          nested.any_non_veg, ITEMS)


def test_parents(spark):
    items = [item("t0", "TOPPING"), item("p1", "PIZZA"), item("t1", "TOPPING"), item("d", "DRINK"), item(None, "PIZZA"),
             item("t2", "TOPPING"), item("p2", "PIZZA"), item("t3", "TOPPING"), item("t4", "topping")]
    got = outcome(spark, [(items, None)], lambda c: F.transform(nested.with_parents(c), lambda r: r["parent"]), ITEMS)
    assert got == [[None, None, "p1", None, None, "p1", None, "p2", None]]
    got = outcome(spark, [([], None), (None, None), ([item("t", "TOPPING"), (None, None, None, None)], None)],
                  lambda c: F.transform(nested.with_parents(c), lambda r: r["parent"]), ITEMS)
    assert got == [[], None, [None, None]]


def test_parents_of_a_very_large_order(spark):
    import time

    rows = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda i: F.struct(
        i.cast("string").alias("ItemNo"), F.when(i % 50 == 1, "PIZZA").otherwise("TOPPING").alias("ItemCatagory"))).alias("v"))
    work = rows.select(nested.with_parents(F.col("v")).alias("v"))
    work.collect()
    start = time.perf_counter()
    (row,) = work.collect()
    assert time.perf_counter() - start < 2
    assert [r["parent"] for r in row.v] == [None if i % 50 == 1 else str(i - (i - 1) % 50) for i in range(1, 10_001)]


PAYMENTS = "v array<struct<Amount:string,Mode:string>>"


def test_payment_summary(spark):
    summary = lambda c: F.struct(nested.payment_modes(c), nested.has_gift_card(c), nested.gift_card_amount(c))
    check(spark, [([("1,000.50", "Gift Card"), ("2", "Cash"), ("3", "Gift Card")], ("Gift Card, Cash, Gift Card", True, 1003.5)),
                  ([("2", "Cash"), ("1", None)], ("Cash", False, 0.0)), ([("x", "Gift Card")], ("Gift Card", True, None)),
                  ([("x", "Gift Card"), ("1", "Cash")], ("Gift Card, Cash", True, 0.0)), ([("1", None)], ("", False, 0.0)),
                  ([("1", "[UPI]")], ("UPI", False, 0.0)), ([], (None, None, None)), (None, (None, None, None))],
          summary, PAYMENTS)


def test_first_scalar(spark):
    rows = spark.sql("select '1' a, array('2', '3') b, named_struct('x', '4', 'y', '5') c, cast(array() as array<string>) d")
    assert tuple(rows.select(*[nested.first_scalar(rows, c) for c in "abcd"]).first()) == ("1", "2", "4", None)
