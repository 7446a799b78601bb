"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Applies the settings to a session.

    ``shuffle_partitions`` is the upper bound that adaptive execution merges from.
    Choose it so that the largest shuffle divided by it is about 256 MB: 100 TB of
    orders wants several hundred thousand, a test eight.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def register_functions(spark: SparkSession) -> None:
    """SQL forms of expressions that users call by name; they inline into the plan."""
    spark.sql("""create or replace temporary function stable_id(value string) returns string
                 return regexp_replace(md5(value), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')""")
