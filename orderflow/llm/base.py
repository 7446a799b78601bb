"""Helpers the operators share: reading, staging, and keyed blocks of packed numbers."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.sources import scratch
from orderflow.sources.scratch import shuffles_dropped

#: Fixed value: what separates words, as a regular expression.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    text = F.coalesce(text, F.lit(""))
    blank = [F.substring(text, place, 1).isin(*" \t\n\x0b\x0c\r").cast("int") for place in (1, -1)]
    parts = F.size(F.split(text, SPACES)) - blank[0] - blank[1]
    return F.when(text == "", F.lit(0)).otherwise(parts).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, which goes when the session ends."""
    spark = df.sparkSession
    path = scratch.new_folder(spark, name)
    df.write.parquet(path)
    forget_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def extended(schema: StructType, ddl: str) -> StructType:
    """``schema`` with the columns of ``ddl`` after its own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def forget_on_exit(spark: SparkSession, path: str) -> None:
    """Has the file system drop ``path`` when the session's process ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def buckets_for(total_bytes: int, each: int, least: int = 8) -> int:
    """How many buckets of about ``each`` bytes hold ``total_bytes``."""
    return max(least, -(-total_bytes // each))


def bucketed(docs: DataFrame, buckets: int, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """``docs`` with a column ``bucket``, stored so that a later grouping by it needs no exchange; and what drops the store.

    Rows spread evenly, whatever they hold: the bucket is a hash of the row's place in the input.
    """
    spark = docs.sparkSession
    files = max(4, buckets // 4)
    path = scratch.new_folder(spark, name)
    view = path.rsplit("/", 1)[1].replace("-", "_")
    (docs.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int"))
     .repartition(files, "bucket")
     .write.bucketBy(files, "bucket").sortBy("bucket").format("parquet")
     .option("compression", "zstd").option("path", path).saveAsTable(view))
    forget_on_exit(spark, path)

    def drop() -> None:
        spark.sql(f"drop table if exists {view}")
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    return spark.table(view), drop


def give_back() -> None:
    """Returns what freed arrays left with the worker's allocators, where the C library can; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def kept(name: str, make):
    """What ``make`` gives, made once in a worker's life: the package itself arrives anew with each task."""
    store = sys.modules.setdefault("orderflow_kept", types.ModuleType("orderflow_kept")).__dict__
    if name not in store:
        give_back()
        store[name] = make()
    return store[name]


# Words of an Arrow string column as numbers -----------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = np.atleast_1d(np.asarray(x, dtype=np.uint64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Fingerprints of words, eight bytes of each at a time; ``data`` is followed by seven spare bytes."""
    window = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,)).copy()
    result = mix(lengths.astype(np.uint64))
    left, longer = lengths, None
    while True:
        chunk = window[starts] & _KEEP[np.minimum(left, 8)]
        if longer is None:
            result = mix(result ^ chunk)
        else:
            result[longer] = mix(result[longer] ^ chunk)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return result
        longer = more if longer is None else longer[more]
        starts, left = starts[more] + 8, left[more] - 8


class Words:
    """The words of an Arrow column of texts: one 64-bit fingerprint each, and where each stands.

    ``of(i)`` is the range of text i's words; ``first`` and ``last`` are their places in ``data``,
    the UTF-8 bytes of all texts. A null text has no words. Memory is about 24 bytes a word.
    """

    def __init__(self, texts: pa.Array | pa.ChunkedArray, fold: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pa.array([], pa.large_string()) if texts is None else texts.cast(pa.large_string()).fill_null("")
        if len(texts) == 0:
            bounds, self.data = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        else:
            bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            self.data = data[bounds[0]:bounds[-1]]
            bounds = bounds - bounds[0]
        self.bounds, size = bounds, len(self.data)
        space = _SPACE[self.data]
        cut = np.zeros(size + 1, dtype=bool)
        cut[bounds] = True
        solid = ~space
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= space[:-1] | cut[1:-1]
        closes[:-1] &= space[1:] | cut[1:-1]
        self.first, self.last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.begin = np.searchsorted(self.first, bounds)
        self.hash = np.empty(len(self.first), dtype=np.uint64)
        edges = np.unique(np.searchsorted(self.first, np.arange(0, size + _SLICE, _SLICE)))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            begin = self.first[a]
            part = self.data[begin:self.last[b - 1]]
            part = np.concatenate([_FOLD[part] if fold else part, np.zeros(7, dtype=np.uint8)])
            self.hash[a:b] = slice_hashes(part, self.first[a:b] - begin, self.last[a:b] - self.first[a:b])

    def __len__(self) -> int:
        return len(self.begin) - 1

    def of(self, i: int) -> slice:
        return slice(int(self.begin[i]), int(self.begin[i + 1]))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` words."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:size].copy()
    for k in range(1, n):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[k:k + size]
    return mix(total)


def pieces(batches: Iterator[pa.RecordBatch], most: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a piece holds at most ``most`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


# Blocks of packed numbers, sent by a range of their fingerprints ---------------------------------------

def segments_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each fingerprint: an equal share of the upper 32 bits' range."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int32)


def split_sorted(hashes: np.ndarray, segments: int) -> Iterator[tuple[int, slice]]:
    """Segments of ascending fingerprints and the slice of each."""
    if len(hashes):
        owner = segments_of(hashes, segments)
        edges = np.flatnonzero(np.diff(owner)) + 1
        for a, b in zip([0, *edges], [*edges, len(hashes)], strict=True):
            yield int(owner[a]), slice(int(a), int(b))


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(value, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer() if isinstance(value, pa.Scalar) else value, dtype=kind)
