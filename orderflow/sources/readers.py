"""Inputs: nested orders, feed, lookups, blocklist, control dates, earlier outputs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.contract import (CHANNEL_COMBINATION_SCHEMA, CHANNEL_DIMENSION_SCHEMA, CHANNEL_LOOKUP_SCHEMA,
                                FEED_DATE, FEED_SCHEMA, FRANCHISE, ORDER_COMBINATION_SCHEMA, ORDER_ROW_TAG,
                                RAW_ORDER_SCHEMA, STORE_COLUMNS, STORE_KEY, STORE_RENAMES)
from orderflow.functions.dates import FLOW_FORMAT, any_date
from orderflow.operators.dedupe import dedupe_by
from orderflow.operators.shape import column, rename


class MissingInput(FileNotFoundError):
    """An input folder that has to be there is not."""


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_orders(spark: SparkSession, path: str, row_tag: str = ORDER_ROW_TAG,
                schema: T.StructType = RAW_ORDER_SCHEMA) -> DataFrame:
    """Nested XML orders, one row per order element, attributes left out, blanks as null."""
    try:
        return (spark.read.format("xml").option("rowTag", row_tag).option("excludeAttribute", True)
                .option("nullValue", "").option("ignoreSurroundingSpaces", False).schema(schema).load(path))
    except AnalysisException as error:
        if is_missing_path(error):
            raise MissingInput(f"no orders at {path}") from error
        raise


def day_folder(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored parquet rows, or none when nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], schema)
        raise


def read_feed(spark: SparkSession, root: str, days: Sequence[date], franchise: str = FRANCHISE,
              schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Feed rows of ``days`` from folders ``root/yyyy/mm/dd``, with the folder day as ``feed_date``.

    All folders are read as one scan. Days without a folder have no rows.
    """
    folders = ",".join(sorted({f"{d:%Y/%m/%d}" for d in days}))
    try:
        rows = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{{{folders}}}/*.parquet")
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(FEED_DATE, T.DateType())]))
        raise
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}/\d{2}/\d{2})/[^/]*$", 1)
    return (rows.withColumn(FEED_DATE, F.to_date(folder, FLOW_FORMAT))
            .filter(column("Franchise") == franchise))


def read_feed_table(spark: SparkSession, path: str, first: date, last: date, franchise: str = FRANCHISE,
                    schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Feed rows from a table partitioned by ``feed_date``; only the partitions in range are read."""
    full = T.StructType([*schema.fields, T.StructField(FEED_DATE, T.DateType())])
    rows = read_or_empty(spark, path, full)
    return rows.filter(F.col(FEED_DATE).between(F.lit(first), F.lit(last)) & (F.col("Franchise") == franchise))


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path))


def read_channel_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Channel or exception lookup; a missing or unreadable id becomes ``-1``."""
    rows = _read_csv(spark, path, CHANNEL_LOOKUP_SCHEMA)
    number = F.col("Channel_Id").try_cast("double").try_cast("int")
    return rows.withColumn("Channel_Id", F.coalesce(number, F.lit(-1)).cast("string"))


def read_channel_dimension(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, CHANNEL_DIMENSION_SCHEMA)


def read_combinations(spark: SparkSession, orders_path: str, channels_path: str) -> tuple[DataFrame, DataFrame]:
    """The two tables of the older combination lookup."""
    return (_read_csv(spark, orders_path, ORDER_COMBINATION_SCHEMA),
            _read_csv(spark, channels_path, CHANNEL_COMBINATION_SCHEMA))


def conform_stores(stores: DataFrame, columns: Sequence[str] = STORE_COLUMNS) -> DataFrame:
    """Store columns under their output names, one row per store code."""
    return dedupe_by(rename(stores.select(*[column(c) for c in columns]), STORE_RENAMES), [STORE_KEY])


def read_stores(spark: SparkSession, path: str, columns: Sequence[str] = STORE_COLUMNS) -> DataFrame:
    return conform_stores(spark.read.parquet(path), columns)


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """Phone numbers out of comma-separated text."""
    numbers = spark.read.text(path).select(F.explode(F.split("value", ",")).alias("number"))
    return numbers.select(F.trim("number").alias("number")).filter(F.col("number") != "").distinct()


def read_control_dates(spark: SparkSession, path: str) -> DataFrame:
    """Load dates, one per run, as dates."""
    rows = spark.read.option("header", True).schema("dates string").csv(path)
    return rows.select(any_date(F.col("dates")).alias("day")).dropna()


def last_load_date(spark: SparkSession, path: str) -> DataFrame:
    """The latest load date as ``yyyy/MM/dd`` text, one row."""
    return read_control_dates(spark, path).agg(F.date_format(F.max("day"), FLOW_FORMAT).alias("last_load_date"))
