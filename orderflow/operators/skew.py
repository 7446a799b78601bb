"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.operators.shape import column
from orderflow.sources.scratch import staged

HOT_ROWS = 100_000   # a key with at least about this many rows is cut into pieces of about this many
# Keys are dealt to this many sketches, each of which tracks that many of them. A key with more than about one in
# 100,000 of all rows is tracked for certain; the list of hot keys has at most one entry per tracked key (4 MB).
SKETCHES, TRACKED = 256, 1024

RARE = 400_000  # as many repeated keys at most are sent to all tasks; with more, all rows shuffle

_RIGHT, _PIECES, _PIECE, _HASH, _SKETCH = "_r_", "_pieces", "_piece", "_key_hash", "_sketch"


def _right_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lookup.withColumnsRenamed({k: _RIGHT + k for k in keys})


def _same_keys(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(column(k), column(_RIGHT + k)) for k in keys]
    return reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def plain_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join to a lookup that is unique on ``keys``; Spark broadcasts it if it is small by its size rule.

    Beyond that the join shuffles, and adaptive execution splits the tasks of hot keys.
    """
    joined = df.join(_right_keys(lookup, keys), _same_keys(keys, null_safe), "left")
    return joined.drop(*[_RIGHT + k for k in keys])


def key_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per key, summed before the shuffle."""
    return df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def _key_hash(keys: Sequence[str], prefix: str = "") -> Column:
    return F.xxhash64(*[column(prefix + k) for k in keys])


def heavy_hitters(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of keys with about ``hot_rows`` rows or more, and into how many pieces each is to be cut.

    One pass of frequent-item sketches over the keys' hashes: no key is counted, and what is shuffled is a
    bounded sketch per task, not a row per key. The counts are estimates, which is enough for cutting: any
    cut gives the same join.
    """
    hashed = df.select(_key_hash(keys).alias(_HASH)).withColumn(_SKETCH, F.pmod(F.col(_HASH), F.lit(SKETCHES)))
    found = hashed.groupBy(_SKETCH).agg(F.expr(f"approx_top_k({_HASH}, {TRACKED}, {TRACKED})").alias("top"))
    return (found.select(F.explode("top").alias("top")).filter(F.col("top.count") >= hot_rows)
            .select(F.col("top.item").alias(_HASH), F.ceil(F.col("top.count") / hot_rows).alias(_PIECES)))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of the keys that more than one row has, found at once in one aggregate of numbers."""
    hashed = df.select(_key_hash(keys).alias(_HASH)).groupBy(_HASH).agg(F.count(F.lit(1)).alias(_PIECES))
    return staged(hashed.filter(F.col(_PIECES) > 1).select(_HASH), "repeated-keys")


def by_repeats(df: DataFrame, keys: Sequence[str], alone: Callable[[DataFrame], DataFrame],
               together: Callable[[DataFrame], DataFrame], rare: int = RARE, repeated: DataFrame | None = None,
           kept: DataFrame | None = None, always: bool = False) -> DataFrame:
    """``together`` of the rows whose key other rows have too, and ``alone`` of all other rows, which need not shuffle.

    ``alone`` is to give what ``together`` gives for a key with one row. Only the list of ``repeated_keys``, of at most
    ``rare`` numbers, goes to all tasks; if more keys repeat, all rows go ``together``. Two keys with one hash are only
    taken for repeated ones. ``df`` is read up to three times, the first time for its keys unless they are given.

    ``kept`` may be a written table of some columns of all rows of ``df``, the keys among them: the result then has these
    columns. Keys and rows that stand alone are read there, and ``df`` only for rows of repeated keys.

    Without a repeated key only ``alone`` is planned. With ``always`` the plan has both parts also then, so that it shows how
    rows of a key would be told apart; adaptive execution leaves the empty part out.
    """
    narrow = df if kept is None else kept
    repeated = repeated_keys(narrow, keys) if repeated is None else repeated
    found = repeated.count()
    if found == 0 and not always:
        return alone(narrow)
    cut = lambda rows: rows if kept is None else rows.select(*[column(c) for c in kept.columns])
    if found > rare:
        return cut(together(df))
    part = lambda rows, how: rows.withColumn(_HASH, _key_hash(keys)).join(F.broadcast(repeated), _HASH, how).drop(_HASH)
    return alone(part(narrow, "left_anti")).unionByName(cut(together(part(df, "left_semi"))))


def lookup_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], null_safe: bool = False,
                spread: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of large ``df`` to large ``lookup``, which is unique on ``keys``.

    Keys of ``df`` with about ``hot_rows`` rows or more (``heavy_hitters``) are cut into
    pieces of about ``hot_rows`` rows; each piece meets a copy of the lookup row. The
    list of hot keys is broadcast, at most one entry per tracked key; the copies
    are at most one per ``hot_rows`` rows of ``df`` and one per hot key. Rows with a null
    key match nothing; each is a piece of its own, so they spread over all tasks.

    A row's piece is a hash of ``spread``, a column that differs from row to row
    (default: of the whole row), so a task that is run again repeats it.
    """
    hot = F.broadcast(heavy_hitters(df if null_safe else df.dropna(subset=list(keys)), keys, hot_rows))
    mixed = F.xxhash64(*[column(c) for c in ([spread] if spread else df.columns)])
    piece = F.when(F.col(_PIECES).isNotNull(), F.pmod(mixed, F.col(_PIECES)))
    if not null_safe:
        piece = piece.when(reduce(Column.__or__, [column(k).isNull() for k in keys]), mixed)
    cut = lambda side: side.withColumn(_HASH, _key_hash(keys)).join(hot, _HASH, "left").drop(_HASH)
    left = cut(df).withColumn(_PIECE, piece.otherwise(F.lit(0))).drop(_PIECES)
    pieces = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)
    right = cut(lookup).withColumn(_PIECE, F.explode(pieces)).drop(_PIECES)
    names = [_RIGHT + k for k in [*keys, _PIECE]]
    joined = left.join(_right_keys(right, [*keys, _PIECE]), _same_keys([*keys, _PIECE], null_safe), "left")
    return joined.drop(_PIECE, *names)
