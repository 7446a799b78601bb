"""The exchange of keys between buckets of documents and segments of the keys' range.

Buckets send the distinct keys of their documents, packed, one row per segment; a segment tells each bucket which
of them others have too. A key in very many documents costs one entry per bucket, so no segment grows hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import packed, split_sorted, staged, unpacked


def distinct_rows(bucket: int, keys: np.ndarray, ids: np.ndarray, segments: int):
    """A bucket's distinct keys, the smallest id of each and whether there are others, a row per segment."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(keys)]]) - 1 if len(keys) else first
    keys, low, more = keys[first], ids[first], ids[first] != ids[last]
    for segment, at in split_sorted(keys, segments):
        yield segment, bucket, packed(keys[at]), packed(low[at]), packed(more[at])


SENT = "segment int, bucket int, keys binary, low binary, more binary"
SENT_ARROW = pa.schema([("segment", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("low", pa.binary()), ("more", pa.binary())])


def sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, SENT_ARROW)], schema=SENT_ARROW)


def answers(exact: bool):
    """What a segment tells each bucket of its keys.

    Not exact: the keys that two different ids have. Exact: those of which some id is smaller than another that the
    bucket has, with the smallest.
    """

    def segment(t: pa.Table) -> pa.Table:
        buckets = t.column("bucket").to_numpy()
        keys = [unpacked(v, np.uint64) for v in t.column("keys")]
        sizes = np.array([len(k) for k in keys], dtype=np.int64)
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        more = np.concatenate([unpacked(v, bool) for v in t.column("more")])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(keys, kind="stable")
        sorted_ = keys[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        group = np.empty(len(keys), dtype=np.int64)
        group[order] = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(keys)]])))
        low = np.concatenate([unpacked(v, np.int64) for v in t.column("low")]) if exact else None
        if exact:
            smallest = np.minimum.reduceat(low[order], first)[group]
            wanted = more | (smallest < low)
        else:
            wanted = (np.bincount(group)[group] > 1) | (np.bincount(group, weights=more)[group] > 0)
        found = np.flatnonzero(wanted)
        rows = np.split(found, np.searchsorted(owner[found], np.arange(1, len(sizes))))
        return pa.table({"bucket": pa.array(buckets, pa.int32()), "keys": pa.array([packed(keys[at]) for at in rows], pa.binary()),
                         "low": pa.array([packed(smallest[at]) if exact else b"" for at in rows], pa.binary())})

    return segment


ANSWERED = "bucket int, keys binary, low binary"


def known_keys(t: pa.Table, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's answers as ascending keys and the smallest id of each."""
    keys = np.concatenate([np.zeros(0, np.uint64), *[unpacked(v, np.uint64) for v in t.column("keys")]])
    low = np.concatenate([np.zeros(0, np.int64), *[unpacked(v, np.int64) for v in t.column("low")]])
    order = np.argsort(keys)
    return keys[order], low[order] if exact else low


def found_at(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of keys in ``known``, or -1."""
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def id_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 for null, and which are not null."""
    solid = np.array(column.is_valid(), dtype=bool)
    return np.array(column.fill_null(0), dtype=np.int64), solid


def answered(sent_rows: DataFrame, exact: bool) -> DataFrame:
    """The segments' answers, a row per bucket and segment, as a table."""
    found = sent_rows.groupBy("segment").applyInArrow(answers(exact), ANSWERED)
    return staged(found.where(F.octet_length("keys") > 0), "answers")
