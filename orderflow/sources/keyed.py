"""State tables in parts by key, of which a run rewrites only those that its keys fall into.

A table is a folder ``run_date=<day>/key_part=<number>/`` of parquet files. Each run writes the parts it touched into a
folder of its own; the newest folder of a part before a day is that part's state. So a run that fails, or is
repeated, leaves the state before it as it was, and parts that no key of a run falls into keep their files.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from orderflow.operators.shape import column
from orderflow.sources.readers import is_missing_path
from orderflow.sources.writers import Watch, as_it_is

RUN, PART = "run_date", "key_part"
#: Parts of a table unless stated otherwise. Choose them so that a part of the whole state is about 1 GB.
PARTS = 64

_FOLDER = re.compile(rf"/{RUN}=(\d{{4}}-\d{{2}}-\d{{2}})/{PART}=(\d+)/")


def key_part(key: Column, parts: int) -> Column:
    """The part of a key: the first 32 bits of its MD5, so that every engine tells it alike; null is the empty text."""
    upper = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10)
    return F.pmod(upper.cast("bigint"), F.lit(parts)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


@dataclass(frozen=True)
class KeyedTable:
    """A state table: where it is, its key, its columns and into how many parts it is cut."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    parts: int = PARTS

    def folders(self, before: date | None = None) -> dict[int, str]:
        """The newest folder of each part, of finished runs before a day. At most one entry a part.

        The names of the table's files, which Spark lists to read it, come to the driver; their content does not.
        """
        try:
            files = self.spark.read.schema(self.schema).parquet(self.path).inputFiles()
        except AnalysisException as error:
            if is_missing_path(error):
                return {}
            raise
        found = {(m[1], int(m[2])) for m in map(_FOLDER.search, files) if m and (before is None or date.fromisoformat(m[1]) < before)}
        done = {run for run in {run for run, _ in found} if _exists(self.spark, f"{self.path}/{RUN}={run}/_SUCCESS")}
        newest: dict[int, str] = {}
        for run, part in sorted(found):
            if run in done:
                newest[part] = f"{self.path}/{RUN}={run}/{PART}={part}"
        return newest

    def read(self, before: date | None = None, only: Sequence[int] | None = None, places: bool = False) -> DataFrame:
        """The state before a day, or parts of it; with ``places``, also its run and part columns."""
        folders = [path for part, path in sorted(self.folders(before).items()) if only is None or part in set(only)]
        full = T.StructType([*self.schema.fields, T.StructField(RUN, T.StringType()), T.StructField(PART, T.IntegerType())])
        if not folders:
            rows = self.spark.createDataFrame([], full)
        else:
            rows = self.spark.read.schema(full).option("basePath", self.path).parquet(*folders)
        return rows if places else rows.select(*[column(f.name) for f in self.schema.fields])

    def parts_of(self, rows: DataFrame, key: str | None = None) -> list[int]:
        """The parts that keys of ``rows`` fall into; at most one number a part comes to the driver."""
        return sorted(r[0] for r in rows.select(key_part(column(key or self.key), self.parts)).distinct().collect())

    def write(self, rows: DataFrame, day: date, watch: Watch = as_it_is) -> None:
        """The rows of whole parts as the state of a run, in place of what an earlier attempt of it left."""
        placed = rows.select(*[column(f.name) for f in self.schema.fields]).withColumn(PART, key_part(column(self.key), self.parts))
        (watch(placed.hint("rebalance", F.col(PART))).write.partitionBy(PART).option("partitionOverwriteMode", "static")
         .mode("overwrite").parquet(f"{self.path}/{RUN}={day}"))

    def merge(self, rows: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame], day: date, key: str | None = None,
              watch: Watch = as_it_is) -> list[int]:
        """Folds the rows of a run into the parts that their keys fall into, and returns those parts.

        ``fold`` gets the state of these parts and ``rows`` and returns their new state; other parts are neither read nor
        written. ``rows`` is read twice, so give it a written table. ``key`` names the key in ``rows`` where it
        differs from the table's. Without rows, nothing is touched.
        """
        touched = self.parts_of(rows, key)
        self.write(fold(self.read(day, touched), rows), day, watch)
        return touched


@dataclass(frozen=True)
class KeyRegister:
    """The keys that runs have stored, by a day that goes with each key; runs append, nothing is rewritten."""

    spark: SparkSession
    path: str
    key: str
    day: str

    def read(self, days: DataFrame, before: date | None = None) -> DataFrame:
        """Keys of finished runs before a day, of the key days in ``days`` (one column) only.

        Spark prunes the scan by them at run time. One row per calendar day bounds their broadcast.
        """
        schema = T.StructType([T.StructField(self.key, T.StringType()), T.StructField(RUN, T.StringType()), T.StructField(self.day, T.StringType())])
        try:
            rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if is_missing_path(error):
                return self.spark.createDataFrame([], schema.fieldNames()[0] + " string, " + self.day + " string")
            raise
        runs = {r for r in re.findall(rf"/{RUN}=(\d{{4}}-\d{{2}}-\d{{2}})/", "\n".join(rows.inputFiles()))
                if (before is None or date.fromisoformat(r) < before) and _exists(self.spark, f"{self.path}/{RUN}={r}/_SUCCESS")}
        wanted = days.select(column(days.columns[0]).cast("string").alias(self.day)).distinct()
        wanted = wanted.filter(F.col(self.day).rlike("."))  # tells Spark that the list is selective, or it would not prune
        return (rows.filter(F.col(RUN).isin(sorted(runs))).join(F.broadcast(wanted), self.day, "left_semi").select(self.key, self.day))

    def append(self, rows: DataFrame, day: date, watch: Watch = as_it_is) -> None:
        """The keys of a run, in place of what an earlier attempt of it left."""
        keys = rows.select(column(self.key), column(self.day).cast("string")).hint("rebalance", F.col(self.day))
        (watch(keys).write.partitionBy(self.day).option("partitionOverwriteMode", "static").mode("overwrite").parquet(f"{self.path}/{RUN}={day}"))
