"""What stays on disk while the daily run goes on: no shuffle files of written tables, and no wide rows where orders meet others."""

import re
import time

from pyspark.sql import functions as F

from orderflow import contract as C
from orderflow.catalog import day
from orderflow.catalog.fixtures import Inputs
from orderflow.operators import channels
from orderflow.plans import daily
from orderflow.sources.scratch import staged


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_staging_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    assert staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
    for _ in range(50):  # they go in the background
        staged_files = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
        if len(staged_files) <= 1:  # that of the count above
            break
        time.sleep(0.1)
    assert len(staged_files) <= 1


def test_orders_meet_others_without_their_other_columns(spark, data, monkeypatch):
    kept = {}

    def stage(df, name):
        kept[name] = staged(df, name)
        return kept[name]

    monkeypatch.setattr(day, "staged", stage)
    header = day.orders(Inputs(spark, data)).header
    assert not {"raw-orders", "final-header"} & set(kept)
    assert kept["new-orders"].columns == daily.SHARED_COLUMNS
    others = set(kept["flat-orders"].columns) - set(daily.SHARED_COLUMNS)
    assert {"City", "NetAmount", "Payment_Mode"} <= others
    assert not others & {*kept["mapped-orders"].columns, *kept["timed-orders"].columns}
    assert others <= set(header.columns)
    plan = header.select("Header_Id", "Day_Part")._jdf.queryExecution().executedPlan().toString()
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*?)>", plan))))
    assert "Enriched_Order_Time" in read and not {"City", "NetAmount", "StoreMaster_Zone"} & read


def test_channel_tables_are_sent_to_the_orders(spark):
    """Also where the size rule is strict: the lookups are written, so their size is known."""
    text = lambda rows, schema: spark.createDataFrame(rows, schema)
    lookup = text([("Web", str(i), str(i)) for i in range(200)], C.CHANNEL_LOOKUP_SCHEMA)
    names = text([(str(i), "s", "c", "f") for i in range(200)], C.CHANNEL_DIMENSION_SCHEMA)
    orders = spark.range(50).select(F.lit("Web").alias("Enriched_Sales_Channel"), F.col("id").cast("string").alias("Enriched_Order_Type"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        mapped = channels.map_channels(orders, lookup, names)
        plan = mapped._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and mapped.filter("Channel_Id is not null").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
