"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products inside them."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from orderflow.llm.base import extended, shuffles_dropped, staged, table
from orderflow.llm.components import components

THRESHOLD = 0.95
#: Vectors that the centroids are learned from at most, rounds of k-means, and most centroids.
SAMPLE, ROUNDS, MOST_CELLS = 16_384, 12, 4096
#: Vectors in a block on average at most, bytes of one on average at most, and blocks that one side of a task holds on average at most.
BLOCK, BLOCK_BYTES, HELD = 1024, 1 << 20, 64
#: Room for rounding in comparisons that only choose candidates.
SLACK = 1e-6


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors, one a row, at length one; not a number for those that have none."""
    largest = np.abs(x).max(axis=1, initial=0.0, keepdims=True)
    largest[(largest == 0) | ~np.isfinite(largest)] = np.nan
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(raw: bytes, width: int, kind: str) -> np.ndarray:
    """The unit vectors of packed vectors of ``width`` numbers each."""
    return _unit(np.frombuffer(raw, dtype=kind).reshape(-1, width).astype(np.float64))


def packed_vectors(vectors: DataFrame, column: str, kind: str) -> DataFrame:
    """``vectors`` with ``raw``, the numbers of a vector packed as they came, and ``digest``, that of its unit vector in double precision.

    Both are null if it has no unit vector: if it is null, empty, zero, or has a null, infinite or not-a-number component.
    """
    names = [n for n in vectors.columns if n != column]

    def rows(batches):
        for batch in batches:
            raws, digests = [], []
            for value in batch.column(column):
                x = value.as_py()
                x = np.array([np.nan] if x is None or None in x else x, dtype=kind)
                unit = _unit(x[None].astype(np.float64))[0]
                told = len(unit) > 0 and np.isfinite(unit).all()
                raws.append(x.tobytes() if told else None)
                digests.append(hashlib.sha256(unit.tobytes()).digest() if told else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(raws, pa.binary()), pa.array(digests, pa.binary())],
                                             names=[*names, "raw", "digest"])

    return vectors.mapInArrow(rows, extended(vectors.select(*names).schema, "raw binary, digest binary"))


def centroids(classes: DataFrame, total: int, cells: int, kind: str) -> dict[int, np.ndarray]:
    """Spherical k-means on a sample of at most ``SAMPLE`` unit vectors, by number of components of a vector.

    Lowest digests first: the sample is the same in every run. The centroids only steer which vectors meet;
    links do not depend on them. Vectors of different lengths live in different spaces.
    """
    share = min(1.0, 1.2 * SAMPLE / max(1, total))
    part = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("double") / 2**32 < share
    rows = classes.where(part).orderBy("digest").limit(SAMPLE).select("raw").collect()
    size, result = np.dtype(kind).itemsize, {}
    for width in {len(r.raw) // size for r in rows}:
        x = _units(b"".join(r.raw for r in rows if len(r.raw) == width * size), width, kind)
        k = min(cells, len(x))
        means = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
        for _ in range(ROUNDS):
            near = (x @ means.T).argmax(axis=1)
            for c in range(k):
                if (near == c).any():
                    total_c = x[near == c].sum(axis=0)
                    means[c] = total_c / (np.linalg.norm(total_c) or 1.0)
        result[width] = means
    return result


class _Cells:
    """The cells of all lengths of vectors. A vector is at home in the cell of its nearest centroid.

    A vector u of cell c is not nearer to v's centroid than to its own, so v . (c0 - c) <= (v - u) . (c0 - c) <=
    |v - u| |c0 - c|. Where the cosine of u and v reaches the threshold, |v - u| is at most
    sqrt(2 - 2 threshold): a vector beyond that from the border of a cell has no partner there. No link is lost.
    """

    def __init__(self, means: dict[int, np.ndarray], threshold: float):
        self.means, self.reach = means, math.sqrt(2 - 2 * threshold) + SLACK

    def home(self, x: np.ndarray) -> np.ndarray:
        means = self.means.get(x.shape[1])
        return self.number(x.shape[1], np.zeros(len(x), int) if means is None else (x @ means.T).argmax(axis=1))

    def number(self, width: int, cell):
        """The number of a cell among those of all lengths; vectors of a length without centroids are all in its cell 0."""
        return width * MOST_CELLS + cell

    def met(self, x: np.ndarray, own: int) -> np.ndarray:
        """The cells in which some vector of ``x``, whose home is ``own``, may have a partner."""
        width = x.shape[1]
        if width not in self.means:
            return np.array([own])
        near = x @ self.means[width].T
        apart = np.linalg.norm(self.means[width] - self.means[width][own % MOST_CELLS], axis=1)
        meets = (near[:, [own % MOST_CELLS]] - near <= self.reach * apart + SLACK).any(axis=0)
        meets[own % MOST_CELLS] = True
        return self.number(width, np.flatnonzero(meets))

    def visits(self, x: np.ndarray, own: int, cell: int) -> np.ndarray:
        """Which vectors of ``x``, whose home is ``own``, may have a partner in ``cell``."""
        if own == cell:
            return np.arange(len(x))
        a, b = (self.means[x.shape[1]][c % MOST_CELLS] for c in (own, cell))
        return np.flatnonzero(x @ (a - b) <= self.reach * np.linalg.norm(a - b) + SLACK)


def _homes(classes: DataFrame, shared, kind: str) -> DataFrame:
    """``classes`` with ``cell``, the home of each."""
    size, names = np.dtype(kind).itemsize, classes.columns

    def rows(batches):
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            lengths = np.array([len(r) for r in raw])
            cell = np.zeros(len(raw), dtype=np.int64)
            for length in set(lengths.tolist()):
                at = np.flatnonzero(lengths == length)
                cell[at] = shared.value.home(_units(b"".join(raw[i] for i in at), length // size, kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=[*names, "cell"])

    return classes.mapInArrow(rows, extended(classes.schema, "cell long"))


def _blocks(homes: DataFrame, shared, kind: str) -> DataFrame:
    """A row per ``cell`` and ``part`` of it: its vectors and their ids and counts, packed, and the cells that some of them visit."""
    size = np.dtype(kind).itemsize

    def pack(t: pa.Table) -> pa.Table:
        raw, cell = t.column("raw").to_pylist(), t.column("cell")[0].as_py()
        x = _units(b"".join(raw), len(raw[0]) // size, kind)
        column = lambda v, k: pa.array([v], k)
        return pa.table({"cell": column(cell, pa.int64()), "width": column(x.shape[1], pa.int32()), "met": column(shared.value.met(x, cell), pa.list_(pa.int64())),
                         **{n: column(t.column(n).to_numpy().astype(np.int64).tobytes(), pa.binary()) for n in ("id", "n")},
                         "raw": column(b"".join(raw), pa.binary())})

    return homes.groupBy("cell", "part").applyInArrow(pack, "cell long, width int, met array<long>, id binary, n binary, raw binary")


def _low(near: np.ndarray, low_a: np.ndarray, low_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each vector of two blocks reaches by their links, found by spreading it along them."""
    largest = np.iinfo(np.int64).max
    while True:
        new_b = np.minimum(low_b, np.where(near, low_a[:, None], largest).min(axis=0, initial=largest))
        new_a = np.minimum(low_a, np.where(near, new_b[None], largest).min(axis=1, initial=largest))
        if (new_a == low_a).all() and (new_b == low_b).all():
            return low_a, low_b
        low_a, low_b = new_a, new_b


def _linked(threshold: float, shared, kind: str):
    """Compares pairs of blocks: a pointer and a count of links for each vector of a pair that has any."""

    def block(batch: pa.RecordBatch, i: int, side: str):
        cell, width = batch.column(f"{side}_cell")[i].as_py(), batch.column(f"{side}_width")[i].as_py()
        ids, n = (np.frombuffer(batch.column(f"{side}_{c}")[i].as_buffer(), dtype=np.int64) for c in ("id", "n"))
        return cell, ids, n, _units(batch.column(f"{side}_raw")[i].as_buffer(), width, kind)

    def rows(batches):
        for batch in batches:
            out = [np.zeros((3, 0), dtype=np.int64)]
            before, left = None, None
            for i in range(batch.num_rows):
                numbers = [batch.column(f"{s}_block")[i].as_py() for s in "ab"]
                if numbers[0] != before:  # a block meets many, one after another
                    before, left = numbers[0], block(batch, i, "a")
                cell_a, id_a, n_a, x = left
                if numbers[0] == numbers[1]:
                    near = x @ x.T >= threshold
                    np.fill_diagonal(near, False)
                    at = np.flatnonzero(near.any(axis=1))
                    near, id_a, n_a = near[np.ix_(at, at)], id_a[at], n_a[at]
                    out.append(np.array([id_a, _low(near, id_a, id_a)[0], near @ n_a]))
                    continue
                cell_b, id_b, n_b, y = block(batch, i, "b")
                a, b = shared.value.visits(x, cell_a, cell_b), shared.value.visits(y, cell_b, cell_a)
                near = x[a] @ y[b].T >= threshold
                at, to = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                near, a, b = near[np.ix_(at, to)], a[at], b[to]
                low_a, low_b = _low(near, id_a[a], id_b[b])
                out += [np.array([id_a[a], low_a, near @ n_b[b]]), np.array([id_b[b], low_b, n_a[a] @ near])]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in np.concatenate(out, axis=1)], names=["a", "b", "links"])

    return rows


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) for each vector: the whole result, found in cells and exact.

    Equal unit vectors are one class, counted and compared once. A class is at home in the cell of its nearest
    centroid and visits other cells by ``_Cells``. The classes of a cell are packed in blocks, each stored once; two blocks are
    multiplied where some vectors of each visit the cell of the other, and only these vectors. Tasks read the blocks of both
    sides from the stored table, so no copy of a vector is shuffled or stored for a cell that it visits. A task returns counts and one
    pointer per vector that has a link in a pair of blocks, never pairs. A pair of blocks meets once, so no link is counted twice.

    Vectors without a unit vector link with nothing and stay. Rows that share a key with another are counted
    row by row; a null key is allowed and never the smallest of a component that has others. Only ``key`` and
    ``column`` are read. No rows give no rows.
    """
    spark = vectors.sparkSession
    element = getattr(vectors.schema[column].dataType, "elementType", None)
    kind, name = ("float32", "float") if isinstance(element, T.FloatType) else ("float64", "double")
    rows = packed_vectors(vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast(f"array<{name}>").alias("v")), "v", kind)
    with shuffles_dropped(spark):
        classes = staged(rows.where("digest is not null").groupBy("digest")
                         .agg(F.min("id").alias("smallest"), F.count("*").alias("n"), F.first("raw").alias("raw"))
                         .withColumn("id", F.monotonically_increasing_id()), "classes")
        total, mean = classes.agg(F.count("*"), F.avg(F.length("raw"))).first()
        means = centroids(classes, total, max(1, min(MOST_CELLS, math.isqrt(total) // 8)), kind)
        shared = spark.sparkContext.broadcast(_Cells(means, threshold))
        homes = _homes(classes.select("id", "n", "raw"), shared, kind)
        each = max(1, min(BLOCK, int(BLOCK_BYTES // (mean or 1))))
        sizes = staged(homes.groupBy("cell").agg(F.ceil(F.count("*") / each).alias("parts")), "cell-sizes")
        count = sizes.agg(F.sum("parts")).first()[0] or 1
        side = max(-(-count // HELD), min(count, math.isqrt(4 * spark.sparkContext.defaultParallelism)), 1)
        parted = homes.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), "parts")).drop("parts")
        blocks = staged(_blocks(parted.repartition(side, "cell", "part"), shared, kind).withColumn("block", F.monotonically_increasing_id()), "blocks")
        a, b = (blocks.coalesce(side).select([F.col(c).alias(f"{s}_{c}") for c in blocks.columns]) for s in "ab")
        meet = F.expr("a_block <= b_block and array_contains(a_met, b_cell) and array_contains(b_met, a_cell)")
        pairs = a.hint("shuffle_replicate_nl").join(b, meet).drop("a_met", "b_met")
        found = pairs.mapInArrow(_linked(threshold, shared, kind), "a long, b long, links long")
        found = staged(found.groupBy("a", "b").agg(F.sum("links").alias("links")), "links")
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    groups = components(found.select("a", "b"))
    labelled = (classes.select("digest", "id", "smallest", "n").join(links, "id", "left").join(groups, "id", "left")
                .withColumn("component", F.coalesce("component", "id")))
    names = labelled.groupBy("component").agg(F.min("smallest").alias("component_id"))
    labelled = labelled.join(names, "component").select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return (rows.join(labelled, "digest", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))))


def op7_spherical_cells(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
