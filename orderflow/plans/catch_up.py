"""Runs the days between the control date and today, in order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.functions.dates import flow_date
from orderflow.sources.readers import is_missing_path, last_load_date
from orderflow.sources.writers import append_control_date

RUN_DATE = "run_date"


def stored_mark(spark: SparkSession, control: str) -> date | None:
    """The latest day that the control file marks as done; None if there is no file or no day in it."""
    try:
        return last_load_date(spark, control).select(flow_date(F.col("last_load_date"))).first()[0]
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def missing_days(spark: SparkSession, control: str, until: date, first: date | None = None) -> list[date]:
    """Days after the control date up to ``until``; from ``first`` on where nothing is marked yet."""
    mark = stored_mark(spark, control)
    if mark is None and first is None:
        raise ValueError(f"no day is marked in {control}: say which day is the first")
    start = first if mark is None else mark + timedelta(days=1)
    return [start + timedelta(days=i) for i in range((until - start).days + 1)]


def catch_up(spark: SparkSession, control: str, until: date, run: Callable[[date], DataFrame], first: date | None = None) -> DataFrame:
    """Runs each missing day in order and moves the mark after each; returns the reports with their day.

    ``run`` does one day and returns its report, a small table that reads nothing of the run any more. A day that fails
    raises and stays unmarked, and no later day is run, so the next call goes on with the day that failed. Without a
    missing day nothing runs, and the report is empty.
    """
    reports = []
    for day in missing_days(spark, control, until, first):
        report = run(day).withColumn(RUN_DATE, F.lit(day))
        reports.append(report)
        append_control_date(spark, control, day)
    if not reports:
        return spark.createDataFrame([], f"stage string, row_count long, {RUN_DATE} date")
    return reduce(DataFrame.unionByName, reports)
