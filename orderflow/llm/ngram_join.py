"""Similarity join of documents by word shingles, and the groups that its links form."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import Words, bucketed, buckets_for, grams, mix, packed, pieces, staged, table, unpacked
from orderflow.llm.components import components
from orderflow.llm.exchange import SENT, answered, distinct_rows, found_at, known_keys, sent

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE, PERCENT = 5, 80
BUCKET_BYTES, SEGMENT_BYTES = 3 << 20, 8 << 20
#: Sets and shingles in a block on average at most, where a group of candidates is large.
BLOCK_SETS, BLOCK_SHINGLES = 400, 1 << 18
#: Leaders that each list of sets compares its members with first.
LEADERS = 2
#: Weight of a heap step against a probe, in the choice of how many lists are long.
STEP_COST = 0.0085


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of ``n`` shares with any linked set, at least."""
    return -(-n * percent // 100)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A text's set, ascending: its shingles, or all words as one if there are fewer, or nothing without words."""
    if 0 < len(words) < size:
        return mix(grams(words, len(words)) ^ np.uint64(len(words)))
    return np.unique(grams(words, size))


def _sample_size(n: int, percent: int) -> tuple[int, int]:
    """How many of a set's lowest shingles tell if it may have a partner, and how many of them must be shared.

    Two linked sets share, among the lowest n - T + l shingles of each (T: ``least_overlap``), l at least. Here l is a
    fifth of a set's size; a partner may be smaller and then has a smaller l.
    """
    return min(n, n - least_overlap(n, percent) + max(1, n // 5)), max(1, least_overlap(n, percent) // 5)


def linked(n: int, m: int, overlap: int, percent: int = PERCENT) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


class Index:
    """Inverted lists over some sets, searched by T-occurrence."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        everything = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(everything, kind="stable")
        keys, owner = everything[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys = keys[first]
        self.lists = [part.tolist() for part in np.split(owner, first[1:])] if len(first) else []

    def search(self, query: np.ndarray, percent: int = PERCENT, skip=lambda i: False):
        """Yields sets, with the overlap, that share ``least_overlap`` of the query's shingles or more (DivideSkip).

        The longest lists are set aside. The short ones are merged by a heap; a set needs T less the number of
        long lists there. Where the lowest sets on the heap cannot reach that, all lists that lag jump by binary
        search to the first set that can. Sets that reach it are looked up in the long lists by binary search.
        """
        at = found_at(query, self.keys)
        lists = sorted((self.lists[i] for i in at[at >= 0]), key=len)
        least = least_overlap(len(query), percent)
        if len(lists) < least or not least:
            return
        n_long = min(least - 1, int(least / (STEP_COST * math.log2(max(2, len(lists[-1]))) + 1)))
        short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        need = least - n_long
        heap = [(own[0], k, 0) for k, own in enumerate(short)]
        heapq.heapify(heap)
        while len(heap) >= need:
            lowest, popped = heap[0][0], []
            while heap and heap[0][0] == lowest:
                popped.append(heapq.heappop(heap))
            if len(popped) >= need:
                if not skip(lowest):
                    overlap = len(popped)
                    for k, own in enumerate(long):
                        if overlap + len(long) - k < least:
                            break
                        place = bisect_left(own, lowest)
                        overlap += place < len(own) and own[place] == lowest
                    if overlap >= least:
                        yield lowest, overlap
                target = lowest + 1
            else:
                while heap and len(popped) < need - 1:
                    popped.append(heapq.heappop(heap))
                if not heap:
                    return
                target = heap[0][0]
            for _, k, place in popped:
                place = bisect_left(short[k], target, place)
                if place < len(short[k]):
                    heapq.heappush(heap, (short[k][place], k, place))


_SETS = "row long, id long, n long, mark binary, shingles binary"


def _sets(docs: DataFrame, key: str, column: str, percent: int) -> DataFrame:
    """Every document's size of set, and the set itself where it may have a partner."""
    held = int(docs.agg(F.sum(F.octet_length(column)).alias("s")).first()["s"] or 0)
    buckets, segments = buckets_for(held, BUCKET_BYTES), buckets_for(held, SEGMENT_BYTES)
    texts, drop = bucketed(docs.select("row", F.col(key).cast("long").alias("id"), F.col(column).alias("text")), buckets, "shingled")

    def lowest(batches):
        for batch in pieces(batches, BUCKET_BYTES):
            numbers, ids, rows = np.array(batch.column("bucket")), np.array(batch.column("row")), []
            for bucket in np.unique(numbers):
                at = np.flatnonzero(numbers == bucket)
                words = Words(batch.column("text").take(pa.array(at)), fold=True)
                sets = [shingles(words.hash[words.of(i)]) for i in range(len(at))]
                sets = [s[:_sample_size(len(s), percent)[0]] for s in sets]
                rows.extend(distinct_rows(int(bucket), np.concatenate(sets), np.repeat(ids[at], [len(s) for s in sets]), segments))
            yield sent([(s, b, k, b"", m) for s, b, k, _, m in rows])

    def chosen(left: pa.Table, right: pa.Table) -> pa.Table:
        known, _ = known_keys(right, False)
        words = Words(left.column("text"), fold=True)
        sizes, marks, held = [], [], []
        for i in range(left.num_rows):
            own = shingles(words.hash[words.of(i)])
            take, need = _sample_size(len(own), percent)
            keep = len(own) > 0 and (found_at(own[:take], known) >= 0).sum() >= need
            sizes.append(len(own))
            held.append(packed(own) if keep else None)
            marks.append(packed(np.concatenate([mix(np.bitwise_xor.reduce(own)), mix(own.sum(dtype=np.uint64))])) if keep else None)
        return pa.table({"row": left.column("row"), "id": left.column("id"), "n": pa.array(sizes, pa.int64()),
                         "mark": pa.array(marks, pa.binary()), "shingles": pa.array(held, pa.binary())})

    shared = answered(texts.select("bucket", "row", "text").mapInArrow(lowest, SENT), False)
    found = staged(texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(chosen, _SETS), "sets")
    drop()
    return found


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(set, token): the rarest shared shingles of each set that can have a partner; linked sets have one in common.

    A set with fewer shared shingles than ``least_overlap`` has no partner. Of the others, the shared shingles are put
    in order of frequency; the first n - T + 1 of a set, less those that it shares with no other, meet the partner's.
    """

    def unpack(batches):
        for batch in batches:
            for name, value in zip(batch.column("set"), batch.column("shingles"), strict=True):
                tokens = unpacked(value, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), name.as_py())), pa.array(tokens)], names=["set", "token"])

    tokens = sets.select("set", "shingles").mapInArrow(unpack, "set long, token long")
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = (tokens.join(common, "token").groupBy("set")
            .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
            .join(sets.select("set", "n"), "set"))
    least = F.ceil(F.col("n") * percent / 100)
    keep = (F.size("shared") - least + 1).cast("int")
    return held.where(keep > 0).select("set", F.explode(F.slice("shared", F.lit(1), keep)).alias("s")).select("set", "s.token")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link."""
    one = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))

    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = unpacked(x, np.uint64), unpacked(y, np.uint64)
                good.append(linked(len(x), len(y), int((found_at(x, y) >= 0).sum()), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    size = F.octet_length
    fits = (100 * size("x") >= percent * size("y")) & (100 * size("y") >= percent * size("x"))
    return pairs.join(one, "a").join(two, "b").where(fits).mapInArrow(check, "a long, b long")


def _leader_links(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of each list and its leaders: as many comparisons as there are members, at most.

    A leader is the member with the lowest hash by a seed, so lists with the same members have the same one.
    """
    lowest = [F.min(F.struct(F.xxhash64("set", F.lit(s)).alias("h"), F.col("set").alias("v")))["v"] for s in range(LEADERS)]
    leaders = prefixes.groupBy("token").agg(F.array(*lowest).alias("leaders"))
    pairs = (prefixes.join(leaders, "token").select("set", F.explode("leaders").alias("leader")).where("set <> leader")
             .select(F.least("set", "leader").alias("a"), F.greatest("set", "leader").alias("b")).distinct())
    return _verified(pairs, sets, percent)


def _searched(percent: int):
    """DivideSkip over one block of a group of candidates, for the queries of another.

    Sets known to be in one component are not compared, and what is found here joins components as it goes.
    """

    def block(t: pa.Table) -> pa.Table:
        t = t.sort_by([("set", "ascending")])
        side, names, labels = (t.column(c).to_pylist() for c in ("side", "set", "label"))
        sets = [unpacked(v, np.uint64) for v in t.column("shingles")]
        data, queries = [i for i, s in enumerate(side) if s == 1], [i for i, s in enumerate(side) if s == 0]
        index, parent, edges = Index([sets[i] for i in data]), {}, []

        def root(x):
            while (up := parent.get(x, x)) != x:
                x = up
            return x

        for q in queries:
            n = len(sets[q])
            for found, overlap in index.search(sets[q], percent, lambda i: root(labels[data[i]]) == root(labels[q])):  # noqa: B023
                if linked(n, index.sizes[found], overlap, percent):
                    edges.append((names[q], names[data[found]]))
                    parent[root(labels[q])] = root(labels[data[found]])
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return block


def _search_links(prefixes: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets that are in different components so far and meet in a list.

    Lists whose members are all in one component are done. The others tie sets into groups of candidates. In a group,
    all sets outside its largest component are queries against all its sets, block by block.
    """
    placed = prefixes.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    mixed = (placed.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("set").alias("first"))
             .where("low <> high").select("token", "first"))
    ties = staged(placed.join(mixed, "token").select("set", "first", "label").distinct(), "ties")
    groups = components(ties.select(F.col("set").alias("a"), F.col("first").alias("b")))
    groups = groups.select(F.col("id").alias("set"), F.col("component").alias("group"))
    members = staged(ties.select("set", "label").distinct().join(groups, "set").join(sets.select("set", "n", "shingles"), "set"), "members")
    parts = members.groupBy("group", "label").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"))
    blocks = lambda sets_, tokens: F.greatest(F.ceil(sets_ / BLOCK_SETS), F.ceil(tokens / BLOCK_SHINGLES), F.lit(1)).cast("int")
    largest = F.max(F.struct("sets", "tokens", "label"))
    sizes = (parts.groupBy("group").agg(F.sum("sets").alias("all_sets"), F.sum("tokens").alias("all_tokens"), largest.alias("main"))
             .select("group", F.col("main.label").alias("main"), blocks(F.col("all_sets"), F.col("all_tokens")).alias("data"),
                     blocks(F.col("all_sets") - F.col("main.sets"), F.col("all_tokens") - F.col("main.tokens")).alias("queries")))
    members = members.join(staged(sizes, "blocks"), "group")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("set"), F.col(n)).cast("int")
    columns = ["set", "label", "shingles"]
    left = members.where("label <> main").select("group", own("queries").alias("i"), spread("data").alias("j"), *columns, F.lit(0).alias("side"))
    right = members.select("group", spread("queries").alias("i"), own("data").alias("j"), *columns, F.lit(1).alias("side"))
    met = left.unionByName(right).repartition("group", "i", "j")  # else the join's partitioning by group would stay
    return met.groupBy("group", "i", "j").applyInArrow(_searched(percent), "a long, b long")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the place of each row as ``row``; the same for each scan of one table."""
    return docs.drop("row").withColumn("row", F.monotonically_increasing_id())


def groups(docs: DataFrame, key: str = "doc_id", column: str = "text", percent: int = PERCENT) -> DataFrame:
    """(row, key, n_shingles, component_id, group) for each row of ``docs``, which has a distinct number ``row`` per row.

    Documents link when 100 * overlap >= ``percent`` * union of their sets of shingles (words folded to lower case
    in A-Z; shingles as 64-bit fingerprints). ``component_id`` is the smallest key that links reach, itself included.

    1. A sample of each set, its lowest shingles, goes packed to segments, which tell what others have too; a set
       whose sample shares too little has no partner and stops there.
    2. Equal sets are one from here on, so exact copies are never paired.
    3. Shared shingles in order of frequency give each set a few lists to meet its partners in.
    4. Lists link their members to leaders; most copies are in one component after that.
    5. Lists that still hold several components are searched by T-occurrence (DivideSkip), in blocks.

    Nothing is left out: each step only drops pairs that cannot link or that are connected already. A document
    without words has an empty set and links with nothing; a null text has no words. A null key takes part and
    is never the smallest while another is in its component. Rows may share a key; ``group`` numbers the components
    whatever their keys. No rows give no rows.
    """
    table_ = _sets(docs, key, column, percent)
    own = table_.where("mark is not null")
    sets = staged(own.groupBy("mark", "n").agg(F.first("shingles").alias("shingles"), F.min("id").alias("low"))
                  .withColumn("set", F.monotonically_increasing_id()), "classes")
    prefixes = staged(_prefixes(sets, percent), "prefixes")
    links = staged(_leader_links(prefixes, sets, percent), "links")
    label = lambda found: found.select(F.col("id").alias("set"), F.col("component").alias("label"))
    first = label(components(links))
    more = staged(_search_links(prefixes, first, sets, percent), "found")
    final = label(components(links.unionByName(more)))
    classes = staged(sets.select("mark", "n", "set", "low").join(final, "set", "left")
                     .select("mark", "n", F.coalesce("label", "set").alias("label"), "low"), "labels")
    smallest = staged(classes.groupBy("label").agg(F.min("low").alias("component_id")), "smallest")
    classes = classes.join(smallest, "label").select("mark", "n", "label", "component_id")
    found = own.select("row", "mark", "n").join(classes, ["mark", "n"]).select("row", "component_id", "label")
    return (table_.select("row", "id", "n").join(found, "row", "left")
            .select("row", F.col("id").alias(key), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id"), F.coalesce("label", -1 - F.col("row")).alias("group")))


def op3_divide_skip(spark: SparkSession, folder: str) -> DataFrame:
    return groups(numbered(table(spark, folder, "documents").select("doc_id", "text"))).drop("row", "group")
