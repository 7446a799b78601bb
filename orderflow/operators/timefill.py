"""Filling missing order times from the times of the same or an earlier store day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderflow.functions.times import clock_of_seconds, day_seconds

_DAY, _STORE, _LAST, _OWN, _EARLIER = "_day", "_store", "_last", "_own", "_earlier"
_DIGEST, _BUCKET, _ROWS, _BEFORE, _LOCAL = "_digest", "_bucket", "_rows", "_before", "_local"
RUN_DIGITS = 4  # hex digits of the digest that name a run: 65,536 runs per store day


def last_times(df: DataFrame, time: str, day: str, store: str) -> DataFrame:
    """The fill value per store day: its latest time, else that of the store day before it.

    Store days are taken by day, then store. The rows are reduced to one per store
    day first. The carry runs per day over its stores, then over one row per day,
    so the only window without a partition has as many rows as there are days.
    """
    latest = df.groupBy(F.coalesce(F.col(day), F.lit("")).alias(_DAY),
                        F.coalesce(F.col(store), F.lit("")).alias(_STORE)).agg(F.max(time).alias(_LAST))
    within = Window.partitionBy(_DAY).orderBy(_STORE).rowsBetween(Window.unboundedPreceding, 0)
    own = latest.withColumn(_OWN, F.last(_LAST, ignorenulls=True).over(within))
    day_end = latest.groupBy(_DAY).agg(F.max(F.when(F.col(_LAST).isNotNull(),
                                                    F.struct(_STORE, _LAST)))[_LAST].alias(_LAST))
    before = Window.orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)
    earlier = day_end.select(_DAY, F.last(_LAST, ignorenulls=True).over(before).alias(_EARLIER))
    return (own.join(earlier, _DAY, "left")
            .select(_DAY, _STORE, F.coalesce(_OWN, _EARLIER).alias(_LAST)))


def fill_times(df: DataFrame, time: str = "Enriched_Order_Time", day: str = "InvoiceDate",
               store: str = "StoreCode", key: str = "Header_Id") -> DataFrame:
    """Missing times become the store day's last time plus 0, 1, 2 ... seconds.

    The rows of a store day are numbered in the order of their key's digest. Its
    first digits split each store day into runs: rows are numbered within a run and
    shifted by the size of the runs before it, so a store day with very many missing
    times is spread over many tasks. Rows that have a time pass through without a
    shuffle; the earliest store days stay null when no time comes before them.
    """
    missing = (df.filter(F.col(time).isNull())
               .withColumns({_DAY: F.coalesce(F.col(day), F.lit("")), _STORE: F.coalesce(F.col(store), F.lit("")),
                             _DIGEST: F.md5(F.col(key))})
               .withColumn(_BUCKET, F.substring(_DIGEST, 1, RUN_DIGITS)))
    sizes = missing.groupBy(_DAY, _STORE, _BUCKET).agg(F.count(F.lit(1)).alias(_ROWS))
    runs = Window.partitionBy(_DAY, _STORE).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn(_BEFORE, F.coalesce(F.sum(_ROWS).over(runs), F.lit(0)))
              .join(last_times(df, time, day, store), [_DAY, _STORE], "left")
              .select(_DAY, _STORE, _BUCKET, _BEFORE, day_seconds(F.col(_LAST)).alias(_LAST)))
    run = Window.partitionBy(_DAY, _STORE, _BUCKET).orderBy(_DIGEST, key)
    numbered = missing.withColumn(_LOCAL, F.row_number().over(run))
    filled = (numbered.join(starts, [_DAY, _STORE, _BUCKET], "left")
              .withColumn(time, clock_of_seconds(F.col(_LAST) + F.col(_BEFORE) + F.col(_LOCAL) - 1))
              .select(*df.columns))
    return df.filter(F.col(time).isNotNull()).unionByName(filled)
