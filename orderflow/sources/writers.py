"""Outputs: partitioned facts, rejects, snapshots, incremental saves, external stores."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from orderflow.functions.dates import FLOW_FORMAT
from orderflow.operators.dedupe import without_keys
from orderflow.operators.quality import REASON
from orderflow.operators.shape import copy_column, untyped_to_text
from orderflow.sources.readers import read_or_empty
from orderflow.sources.scratch import staged

PARTITION = "partition_date"
#: Takes what is written and gives it back, to count it on the way.
Watch = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def write_facts(df: DataFrame, path: str, date_column: str, mode: str = "overwrite", watch: Watch = as_it_is) -> None:
    """Parquet partitioned by a copy of ``date_column``.

    Rows are rebalanced by day before the write: small days share a file, a day
    with very many rows is split over several tasks. ``path`` belongs to one run,
    so the default replaces what an earlier attempt of that run left.
    """
    rows = copy_column(untyped_to_text(df), date_column, PARTITION)
    watch(rows.hint("rebalance", F.col(PARTITION))).write.partitionBy(PARTITION).mode(mode).parquet(path)


def write_rejects(df: DataFrame, path: str, reason: str | None = None, mode: str = "overwrite") -> None:
    """Rows set aside, with why."""
    rows = df if reason is None else df.withColumn(REASON, F.lit(reason))
    untyped_to_text(rows).write.mode(mode).parquet(path)


def write_keys(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A key list as CSV with a header, spaces around values kept."""
    (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .mode(mode).csv(path))


def write_snapshot(df: DataFrame, path: str, files: int | None = None) -> None:
    """A full table, replaced as a whole; ``files`` merges the output into that many files."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Rows to a database table. The caller supplies address and credentials."""
    df.write.jdbc(url, table, mode, properties)


def unsaved_rows(df: DataFrame, stored: DataFrame, date_column: str, key: str = "Header_Id") -> DataFrame:
    """Rows of days and keys that are not stored yet."""
    return without_keys(df, stored, [date_column, key])


def save_report(df: DataFrame, stored: DataFrame, date_column: str, key: str = "Header_Id") -> DataFrame:
    """Total, saved and skipped rows per day of an incremental save."""
    total = df.groupBy(date_column).agg(F.count(F.lit(1)).alias("total"))
    saved = unsaved_rows(df, stored, date_column, key).groupBy(date_column).agg(F.count(F.lit(1)).alias("saved"))
    return (total.join(saved, date_column, "left").na.fill({"saved": 0})
            .withColumn("skipped", F.col("total") - F.col("saved")))


def save_new_rows(df: DataFrame, path: str, date_column: str, key: str = "Header_Id") -> DataFrame:
    """Appends what is not stored, all days in one pass, and returns the report of the save.

    Only the stored partitions of the days in ``df`` are read. ``date_column`` may be text
    that holds anything, so Spark chooses by size how its days are joined. ``df`` is read more than once, so give it a
    written table. The report is written before the rows, as the rows change what is
    stored.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(PARTITION, T.StringType())])
    days = df.select(F.col(date_column).cast("string").alias(PARTITION)).distinct()
    stored = (read_or_empty(df.sparkSession, path, schema).join(days, PARTITION, "left_semi")
              .select(date_column, key))
    report = staged(save_report(df, stored, date_column, key), "save-report")
    write_facts(unsaved_rows(df, stored, date_column, key), path, date_column, mode="append")
    return report


def append_control_date(spark: SparkSession, path: str, day: date) -> None:
    """One more load date at the end of the control file."""
    text = F.date_format(F.lit(day), FLOW_FORMAT).alias("dates")
    spark.range(1).select(text).write.option("header", True).mode("append").csv(path)


def put_batches(df: DataFrame, put: Callable[[list[Row]], None], size: int = 25) -> None:
    """Hands rows to an external store in batches, from the executors.

    ``put`` writes one batch by key, so a repeated task repeats the same writes.
    """
    def send(rows: Iterable[Row]) -> None:
        rows = iter(rows)
        while batch := list(islice(rows, size)):
            put(batch)

    df.foreachPartition(send)
