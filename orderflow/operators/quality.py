"""Mandatory fields, reject reasons and run counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from orderflow.operators.shape import column

REASON = "reject_reason"


def any_missing(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [column(c).isNull() for c in columns])


def split_mandatory(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Complete rows, and incomplete rows with the names of what they lack."""
    lacking = F.concat_ws(",", *[F.when(column(c).isNull(), F.lit(c)) for c in columns])
    missing = any_missing(columns)
    rejects = df.filter(missing).withColumn(REASON, F.concat(F.lit("missing:"), lacking))
    return df.filter(~missing), rejects


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column, one row each, from one pass."""
    counts = df.agg(*[F.count_if(column(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], [column(c) for c in columns], "column_name", "null_count")


def run_report(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per stage. Give it written tables: each stage is read once."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(stage).alias("stage"), "row_count")
             for stage, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)


class RunCounts:
    """Counts taken while rows are written, so that no table is read again to be counted.

    Give ``watch`` what is written next and write it as it comes back: counts made in the last stage of a job are exact
    also if tasks run again, those of an earlier stage might count a task twice.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []
        self._given: dict[str, int] = {}

    def watch(self, df: DataFrame, **counts: Column | None) -> DataFrame:
        """``df``, with the rows of each condition counted under its name when it is written; None counts all rows."""
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(n) for n, c in counts.items()])

    def put(self, **counts: int) -> None:
        """Counts that are known otherwise."""
        self._given |= counts

    def rows(self) -> dict[str, int]:
        """All counts by name, in the order in which they were asked for; waits for the writes."""
        found: dict[str, int] = {}
        for seen in self._seen:
            found |= {name: int(n or 0) for name, n in seen.get.items()}
        return found | self._given

    def report(self, spark: SparkSession, stages: Sequence[str] | None = None) -> DataFrame:
        """One row per stage, as ``run_report`` gives."""
        counts = self.rows()
        return spark.createDataFrame([(s, counts[s]) for s in (stages or counts)], "stage string, row_count long")
