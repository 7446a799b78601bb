"""Duplicate removal with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from orderflow.operators.shape import column
from orderflow.operators.skew import RARE, by_repeats, lookup_join

_RANK, _FOUND, _DIGEST = "_rank", "_found", ["_digest_a", "_digest_b"]


def row_digest(df: DataFrame, columns: Sequence[str], exact: bool = False) -> list[Column]:
    """128 bits that tell rows apart by ``columns``, as two numbers.

    Nulls count by their place: hashing alone would pass over them, so that (null, a) and (a, null) were one.
    Nested columns count by their value and their text, in which a null reads like the text ``null``; with ``exact``
    by their JSON, which takes longer and leaves no doubt.
    """
    parts = row_values(df, columns, exact)
    return [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]


def row_values(df: DataFrame, columns: Sequence[str], exact: bool = False) -> list[Column]:
    """What ``row_digest`` hashes of ``columns``. A struct of it hashes like its parts, and is built once for several hashes."""
    parts = []
    for field in (df.schema[c] for c in columns):
        value = [column(field.name)]
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            value = [F.to_json(F.struct(*value), {"ignoreNullFields": "false"})] if exact else [*value, value[0].cast("string")]
        parts += [*value, column(field.name).isNull()]
    return parts


def dedupe_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by a digest of all other columns.

    The survivor does not depend on partitioning, and sorting never compares
    nested columns. Because only rank one is kept, Spark cuts every group down to
    one row per map task before the shuffle, so a key that holds a large share of
    the rows does not gather in one task. ``key_ledger`` tells which keys had ties
    of different rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*order, *_DIGEST)
    ranked = df.withColumns(dict(zip(_DIGEST, row_digest(df, rest), strict=True))).withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK, *_DIGEST)


def dedupe_rare(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), rare: int = RARE,
                repeated: DataFrame | None = None, kept: DataFrame | None = None, always: bool = False) -> DataFrame:
    """``dedupe_by`` for wide rows whose keys seldom repeat: only rows of repeated keys are hashed, sorted and shuffled.

    ``repeated`` may give the ``repeated_keys`` of ``df``, where they are known, and ``kept`` a written table of the columns
    of ``df`` that are wanted; which row of a key is taken is told by all columns of ``df`` in either case. ``always`` is that of ``by_repeats``.
    """
    return by_repeats(df, keys, lambda rows: rows, lambda rows: dedupe_by(rows, keys, order), rare, repeated, kept, always)


def key_ledger(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: ``row_count``, and ``conflicting`` if its rows differ (else they are copies).

    The smallest and the largest digest of a key differ if its rows do. One hash
    aggregate of numbers, summed up before the shuffle: the rows themselves, however
    wide, stay where they are. Null keys are keys of their own.
    """
    digests = row_digest(df, [c for c in df.columns if c not in keys], exact=True) if set(df.columns) - set(keys) else [F.lit(0), F.lit(0)]
    rows = df.select(*[column(k) for k in keys], *[d.alias(n) for n, d in zip(_DIGEST, digests, strict=True)])
    spans = [f(n).alias(f"{n}_{f.__name__}") for n in _DIGEST for f in (F.min, F.max)]
    folded = rows.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"), *spans)
    differ = reduce(Column.__or__, [F.col(f"{n}_min") != F.col(f"{n}_max") for n in _DIGEST])
    return folded.select(*[column(k) for k in keys], "row_count", differ.alias("conflicting"))


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys under which different rows came, with how many rows each has."""
    return key_ledger(df, keys).filter("conflicting").drop("conflicting")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[column(c) for c in columns]).distinct()


def _stored(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stored.select(*[column(k) for k in keys]).distinct()


def without_keys(df: DataFrame, stored: DataFrame, keys: Sequence[str], spread: str | None = None) -> DataFrame:
    """Rows whose key is not in ``stored``.

    ``spread`` names a column that tells rows of one key apart, for rows that may
    repeat a key very often; leave it out where ``df`` has one row per key.
    """
    if spread is None:
        return df.join(_stored(stored, keys), list(keys), "left_anti")
    return _flagged(df, stored, keys, spread).filter(F.col(_FOUND).isNull()).drop(_FOUND)


def with_keys(df: DataFrame, stored: DataFrame, keys: Sequence[str], spread: str | None = None) -> DataFrame:
    """Rows whose key is in ``stored``; ``spread`` as for ``without_keys``."""
    if spread is None:
        return df.join(_stored(stored, keys), list(keys), "left_semi")
    return _flagged(df, stored, keys, spread).filter(F.col(_FOUND).isNotNull()).drop(_FOUND)


def _flagged(df: DataFrame, stored: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    return lookup_join(df, _stored(stored, keys).withColumn(_FOUND, F.lit(True)), keys, spread=spread)
