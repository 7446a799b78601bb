"""Joins and numbering under keys that hold a large share of the rows."""

import hashlib
from collections import Counter, defaultdict

import pytest
from conftest import values
from pyspark.sql import functions as F

from orderflow.operators import dedupe, phones, skew, timefill


def hot_rows(spark, n=3000):
    """A third of the rows share one key, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("hot", [1, 20, 500, 10 ** 9])
@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_join_equals_plain_join(spark, hot, null_safe):
    rows = hot_rows(spark)
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), (None, 4), ("other", 5)], "k string, v int")
    got = skew.lookup_join(rows, table, ["k"], null_safe=null_safe, hot_rows=hot, spread="id")
    lookup = {"hot": 1, "k1": 2, "k7": 3, "other": 5} | ({None: 4} if null_safe else {})
    want = sorted((r.id, r.k, lookup.get(r.k)) for r in rows.collect())
    assert sorted(tuple(r) for r in got.collect()) == want


def test_hot_key_is_spread(spark):
    rows = hot_rows(spark)
    table = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew.lookup_join(rows, table, ["k"], hot_rows=100, spread="id")
        parts = got.withColumn("p", F.spark_partition_id()).groupBy("k", "p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot, none = ([r["count"] for r in parts if r.k == k] for k in ("hot", None))
    assert sum(hot) == 1000 and len(hot) >= 5 and max(hot) < 500
    assert sum(none) == 200 and len(none) == 8


def test_heavy_hitters_without_a_cut(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") < 30_000, F.col("id") % 15_000).otherwise(F.lit(-1) - F.col("id") % 3).alias("k"))
    two, three = (skew.heavy_hitters(rows, ["k"], hot) for hot in (2, 10_000))
    assert two.count() == 15_003  # as many as there are, however many
    assert sorted(r[1] for r in three.collect()) == [1, 1, 1]
    assert {r[0] for r in three.collect()} == {r[0] for r in spark.range(3).select(F.xxhash64(F.lit(-1) - F.col("id"))).collect()}
    few = spark.createDataFrame([(i, i) for i in range(15_000)], "k long, v long")
    got = skew.lookup_join(rows, few, ["k"], hot_rows=2)
    assert got.count() == 60_000 and got.filter("v = k").count() == 30_000


def test_sketches_find_every_key_above_their_share(spark, monkeypatch):
    monkeypatch.setattr(skew, "TRACKED", 16)
    monkeypatch.setattr(skew, "SKETCHES", 4)
    rows = spark.range(50_000).select(F.when(F.col("id") % 4 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"))
    (hot,) = skew.heavy_hitters(rows, ["k"], 10_000).collect()
    assert hot[0] == spark.range(1).select(F.xxhash64(F.lit(-7).cast("long"))).first()[0] and hot[1] == 2
    assert skew.lookup_join(rows, rows.distinct().withColumn("v", F.lit(1)), ["k"], hot_rows=1000).filter("v = 1").count() == 50_000


def test_small_lookups_are_broadcast_without_a_count(spark):
    rows = hot_rows(spark)
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    joined = skew.plain_join(rows, table, ["k"])
    assert values(joined) == values(skew.lookup_join(rows, table, ["k"]))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_daily_counts_with_hot_number(spark, monkeypatch):
    rows = hot_rows(spark).select(F.col("id").cast("string").alias("Header_Id"), F.col("k").alias("PhoneNo"),
                                  F.lit(None).cast("string").alias("MobileNo"),
                                  F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("InvoiceDate"))
    plain = [(r.Header_Id, r.PhoneNo, r.InvoiceDate) for r in rows.collect()]
    counts = Counter((p, d) for _, p, d in plain)
    got = phones.validate_phones(rows).select("Header_Id", phones.DAILY).collect()
    assert {r[0]: r[1] for r in got} == {h: counts[(p, d)] for h, p, d in plain}


def test_dedupe_limits_groups_before_the_shuffle(spark):
    rows = hot_rows(spark)
    plan = dedupe.dedupe_by(rows, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_dedupe_does_not_depend_on_partitions(spark):
    rows = hot_rows(spark).withColumn("x", F.col("id") % 7)
    want = values(dedupe.dedupe_by(rows, ["k"], [F.col("x").desc()]))
    for parts in (1, 7):
        assert values(dedupe.dedupe_by(rows.repartition(parts), ["k"], [F.col("x").desc()])) == want


def by_hand(rows):
    """Fill values straight from the rule: walk store days in order, keep the last time, count seconds."""
    days = defaultdict(list)
    for h, d, s, t in rows:
        days[(d or "", s or "")].append((h, t))
    last, out = None, {}
    for key in sorted(days):
        known = [t for _, t in days[key] if t is not None]
        last = max(known) if known else last
        missing = sorted((hashlib.md5(h.encode()).hexdigest(), h) for h, t in days[key] if t is None)
        for place, (_, h) in enumerate(missing):
            if last is None:
                out[h] = None
            else:
                s = (int(last[:2]) * 3600 + int(last[3:5]) * 60 + int(last[6:]) + place) % 86400
                out[h] = f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"
        out |= {h: t for h, t in days[key] if t is not None}
    return out


def test_time_fill_by_hand(spark):
    rows = [(str(i), f"2024/01/{1 + i % 5:02d}", f"S{i % 3}",
             None if i % 4 == 0 or i % 5 == 0 else f"{(i * 7) % 24:02d}:{i % 60:02d}:59") for i in range(400)]
    rows += [(f"h{i}", "2024/01/03", "S1", None) for i in range(900)]
    rows += [("late", "2024/01/09", "S0", "23:59:58")] + [(f"w{i}", "2024/01/09", "S0", None) for i in range(5)]
    frame = spark.createDataFrame(rows, "Header_Id string, InvoiceDate string, StoreCode string, Enriched_Order_Time string")
    want = by_hand(rows)
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = timefill.fill_times(frame).collect()
        assert {r.Header_Id: r.Enriched_Order_Time for r in got} == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")
