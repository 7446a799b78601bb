"""Scoring by an n-gram model whose quantised counts live in a log-frequency Bloom filter."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import (Words, bucketed, buckets_for, extended, give_back, mix, packed, pieces, segments_of, shuffles_dropped,
                                split_sorted, staged, table, unpacked)
from orderflow.llm.exchange import found_at
from orderflow.llm.language import remainder

ORDER = 3
#: Probes per level, and the base of the logarithm by which counts are quantised.
PROBES, BASE = 3, 2.0
#: Bits of the filter per token of the training texts and order above the first, and the most bits of a filter that is broadcast; a larger one
#: stays a table of segments that n-grams are sent to.
BITS_PER_TOKEN, MOST_BITS = 8, 1 << 29
#: Most words whose exact counts are broadcast; a larger vocabulary is joined.
MOST_WORDS = 1 << 24
#: Weight of the longest order in the interpolation; each shorter one takes the same share of the rest.
WEIGHT = 0.6
#: Training text per segment of the counting shuffle, and scored text per bucket that sends its n-grams to segments.
SEGMENT_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
#: N-grams that a segment looks up at a time, and buckets whose requests it unpacks at a time.
PROBED, ASKING = 1 << 20, 16
#: Parts of the buckets that ask one after another, so that the requests of one part only are on disk.
WAVES = 2
#: Bytes of the fingerprint of an n-gram of two tokens or more. Two that agree only add to the filter's false hits.
LONG = 6
#: Fixed fingerprint of the end of a text.
END = np.uint64(0x5851F42D4C957F2D)


def ngrams(words: Words, order: int) -> list[np.ndarray]:
    """Fingerprints of the runs of 1 to ``order`` tokens that end at each token, a text's words and one end each.

    At a text's start, where a run would begin before it, the entry is 0. Of runs of two or more, the upper ``LONG`` bytes are used.
    """
    n = np.diff(words.begin)
    ends = np.cumsum(n + 1) - 1
    tokens = np.empty(int((n + 1).sum()), dtype=np.uint64)
    solid = np.ones(len(tokens), dtype=bool)
    solid[ends] = False
    tokens[solid], tokens[ends] = words.hash, END
    place = np.arange(len(tokens)) - np.repeat(ends - n, n + 1)
    result = [tokens]
    for k in range(1, order):
        run = mix(np.roll(result[-1], 1) * np.uint64(0x9E3779B97F4A7C15) + tokens)
        run[place < k] = 0
        result.append(run)
    return [tokens, *[run & ~np.uint64((1 << 64 - 8 * LONG) - 1) for run in result[1:]]]


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log_BASE count)."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of those that are quantised to it; 0 for level 0."""
    low = BASE ** (levels - 1.0)
    return np.where(levels > 0, (low + np.maximum(low, BASE ** levels - 1)) / 2, 0.0)


class Filter:
    """Bits in ``segments`` equal parts; all probes of an n-gram fall into the part of its fingerprint."""

    def __init__(self, bits: int, segments: int, data: bytes | None = None):
        self.part, self.segments = max(64, bits // segments // 8 * 8), segments
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(self.part * segments // 8, dtype=np.uint8)

    def places(self, grams: np.ndarray, level, base: np.ndarray):
        """Bit numbers probed for each n-gram at a level, one array per probe."""
        one = mix(grams ^ mix(np.asarray(level, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))
        two = mix(one) | np.uint64(1)
        for k in range(PROBES):
            yield base + ((one + np.uint64(k) * two) % np.uint64(self.part)).astype(np.int64)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probes go on, level by level, until one misses."""
        result = np.zeros(len(grams), dtype=np.int64)
        left = np.flatnonzero(grams != 0)
        level = 1
        while len(left):
            own = grams[left]
            base = segments_of(own, self.segments).astype(np.int64) * self.part
            hit = np.ones(len(left), dtype=bool)
            for place in self.places(own, level, base):
                hit &= (self.data[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            left = left[hit]
            result[left] = level
            level += 1
            if level > 64:
                break
        return result


def squeezed(keys: np.ndarray, width: int = 8) -> bytes:
    """The upper ``width`` bytes of ascending keys as differences, byte by byte: their uppermost bytes are zeros that a shuffle's codec takes out."""
    steps = np.diff(keys, prepend=np.uint64(0)) >> np.uint64(64 - 8 * width)
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def spread(value, width: int = 8) -> np.ndarray:
    """The keys that ``squeezed`` packed."""
    stored = unpacked(value, np.uint8).reshape(width, -1)
    steps = np.zeros((stored.shape[1], 8), dtype=np.uint8)
    steps[:, :width] = stored.T
    return np.cumsum(steps.view(np.uint64).reshape(-1), dtype=np.uint64) << np.uint64(64 - 8 * width)


_SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
_COUNTED = "segment int, tokens long, known long, words binary, counts binary, bits binary"


def _counts(texts: DataFrame, order: int, segments: int) -> DataFrame:
    """Packed n-gram counts of each piece of text, a row per piece and segment."""

    def rows(batches):
        for batch in pieces(batches, 4 << 20):
            runs = ngrams(Words(batch.column("text"), fold=True), order)
            found = []
            for k, run in enumerate(runs):
                grams, counts = np.unique(run[run != 0], return_counts=True)
                found.append({s: (grams[at], counts[at]) for s, at in split_sorted(grams, segments)})
            for segment in sorted(set().union(*found)):
                one, more = found[0].get(segment), [f[segment] for f in found[1:] if segment in f]
                none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                one = one or none
                long = tuple(np.concatenate([m[i] for m in more]) if more else none[i] for i in (0, 1))
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([segment], pa.int32()), "words": [packed(one[0])],
                    "n": [packed(one[1].astype(np.uint32))], "grams": [squeezed(long[0], LONG)],
                    "m": [packed(np.minimum(long[1], 255).astype(np.uint8))],
                    "over": [packed(np.concatenate([np.flatnonzero(long[1] > 255), long[1][long[1] > 255]]).astype(np.int64))]})

    return texts.select("text").mapInArrow(rows, "segment int, words binary, n binary, grams binary, m binary, over binary")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (keys, counts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)


def _merged(bits: int, segments: int):
    """Sums up a segment's counts and sets its bits."""

    def segment(t: pa.Table) -> pa.Table:
        words, n, grams, m = [], [], [], []
        for row in t.to_pylist():
            words.append(unpacked(row["words"], np.uint64))
            n.append(unpacked(row["n"], np.uint32))
            grams.append(spread(row["grams"], LONG))
            count = unpacked(row["m"], np.uint8).astype(np.int64)
            over = unpacked(row["over"], np.int64).reshape(2, -1)
            count[over[0]] = over[1]
            m.append(count)
        words, n = _summed(words, n)
        own = Filter(bits, segments)
        own.segments, own.data = 1, np.zeros(own.part // 8, dtype=np.uint8)
        for keys, counts in ((words, n), _summed(grams, m)):
            levels, level = level_of(counts) if len(counts) else counts, 1
            while len(keys):
                for place in own.places(keys, level, np.zeros(len(keys), dtype=np.int64)):
                    np.bitwise_or.at(own.data, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
                level += 1
                keys, levels = keys[levels >= level], levels[levels >= level]
        give_back()
        return pa.table({"segment": t.column("segment").slice(0, 1), "tokens": pa.array([int(n.sum())]), "known": pa.array([len(words)]),
                         "words": pa.array([packed(words)]), "counts": pa.array([packed(n)]), "bits": pa.array([packed(own.data)])})

    return segment


def _told(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key among ascending known ones, or 0."""
    at = found_at(keys, known)
    return np.where(at >= 0, values[at], 0) if len(known) else np.zeros(len(keys), dtype=np.int64)


def _probed(own: Filter, keys: list[np.ndarray]) -> list[np.ndarray]:
    """Levels of the keys of each list, looked up in about PROBED at a time."""
    ends = np.cumsum([len(k) for k in keys])
    parts = np.split(np.arange(len(keys)), np.flatnonzero(np.diff(ends // PROBED)) + 1) if keys else []
    result = []
    for part in parts:
        levels = own.levels(np.concatenate([keys[i] for i in part])).astype(np.uint8)
        result.extend(np.split(levels, np.cumsum([len(keys[i]) for i in part])[:-1]))
    return result


def _distinct(runs: list[np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Distinct words, ascending, and the place of each token among them; likewise the distinct n-grams of all longer orders."""
    return (np.unique(runs[0], return_inverse=True),
            np.unique(np.concatenate([np.zeros(0, np.uint64), *runs[1:]]), return_inverse=True))


def _scores(words: Words, order: int, total: int, known: int, levels, longer_levels, counts) -> list[pa.Array]:
    """The columns of _SCORED; ``levels`` and ``counts`` tell quantised and exact counts of distinct words, ``longer_levels`` those of distinct n-grams."""
    base = math.log10(total + 0.5 * (known + 1))
    runs = ngrams(words, order)
    tokens = runs[0]
    first = np.concatenate([[0], np.cumsum(np.diff(words.begin) + 1)[:-1]]).astype(np.int64)
    sums = lambda values: np.add.reduceat(values, first) if len(words) else values
    (distinct, inverse), (grams, back) = _distinct(runs)
    c = counts(distinct)
    single = count_of(levels(distinct))[inverse]
    low = (single + 0.5) / (total + 0.5 * (known + 1))
    mixed = np.zeros(len(tokens))
    rest = np.ones(len(tokens))
    found = [single, *count_of(longer_levels(grams))[back].reshape(order - 1, len(tokens))]
    for k in range(order - 1, 0, -1):
        under = np.roll(found[k - 1], 1)
        usable = (runs[k] != 0) & (under > 0)
        weight = np.where(usable, WEIGHT, 0.0)
        mixed += rest * weight * np.minimum(1.0, found[k] / np.maximum(under, 1e-9))
        rest *= 1 - weight
    mixed += rest * low
    return [pa.array(np.diff(words.begin) + 1, pa.int64()), pa.array(sums((c > 0).astype(np.int64)[inverse]), pa.int64()),
            pa.array(np.full(len(words), total), pa.int64()), pa.array(sums((np.log10(c + 0.5) - base)[inverse])),
            pa.array(sums(np.log10(mixed)))]


class Model:
    """Counts of a training corpus: a table of segments, and what the driver needs of it."""

    def __init__(self, texts: DataFrame, order: int = ORDER, most_bits: int = MOST_BITS, most_words: int = MOST_WORDS):
        size = texts.agg(F.sum(F.octet_length("text")).alias("s"), F.count("*").alias("n")).first()
        self.order, self.spark = order, texts.sparkSession
        held = int(size["s"] or 0) + int(size["n"])
        self.segments = buckets_for(held, SEGMENT_BYTES, 16)
        self.bits = max(1 << 16, held // 6 * BITS_PER_TOKEN * max(1, order - 1))
        with shuffles_dropped(self.spark):
            self.table = staged(_counts(texts, order, self.segments).groupBy("segment")
                                .applyInArrow(_merged(self.bits, self.segments), _COUNTED), "ngrams")
        total = self.table.agg(F.sum("tokens").alias("t"), F.sum("known").alias("k")).first()
        self.tokens, self.known = int(total["t"] or 0), int(total["k"] or 0)
        self.small = self.bits <= most_bits and self.known <= most_words
        self.filter = self.words = None
        if self.small:
            part = Filter(self.bits, self.segments).part
            data = bytearray(part * self.segments // 8)
            for row in self.table.select("segment", "bits").toLocalIterator():
                data[row["segment"] * part // 8:(row["segment"] + 1) * part // 8] = row["bits"]
            self.filter = self.spark.sparkContext.broadcast(bytes(data))
            found = self.table.select("segment", "words", "counts").orderBy("segment").toLocalIterator()
            pairs = [(row["words"], row["counts"]) for row in found]
            self.words = self.spark.sparkContext.broadcast(
                (np.frombuffer(b"".join(w for w, _ in pairs), dtype=np.uint64), np.frombuffer(b"".join(c for _, c in pairs), dtype=np.int64)))

    def score(self, docs: DataFrame, column: str = "text") -> DataFrame:
        """``docs`` without ``column`` but with n_tokens, n_known, train_tokens, base_score and score.

        ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens with exact counts c, N tokens and V
        distinct ones in training. ``score`` is the model's log10 probability: at each token, orders 1 to
        ``order`` are interpolated; an order's share is the quantised count of the run over that of the run
        before its last token (at most 1), the lowest is smoothed as in ``base_score``. The quantised counts are
        what probes of the filter tell; a filter errs only upwards, by false hits.

        Filter and exact counts are broadcast while the filter has at most ``most_bits`` bits and the vocabulary at
        most ``most_words`` words; else buckets of texts send their distinct n-grams to the segments and get the
        levels and counts back, with the same result. Null counts as an empty text, which has the end as its only
        token. Words are told apart by 64-bit fingerprints. An empty corpus gives every token the same share.
        Columns of the names added go.
        """
        docs = docs.drop(*[f.split()[0] for f in _SCORED.split(", ")])
        return self._broadcast(docs, column) if self.small else self._exchanged(docs, column)

    def _broadcast(self, docs: DataFrame, column: str) -> DataFrame:
        """Scores in one pass, where each worker holds the whole model."""
        carried = [c for c in docs.columns if c != column]
        total, known, order, filtered, exact = self.tokens, self.known, self.order, self.filter, self.words
        bits, segments = self.bits, self.segments
        names = [*carried, *[f.split()[0] for f in _SCORED.split(", ")]]

        def rows(batches):
            own = Filter(bits, segments, filtered.value)
            words, counts = exact.value
            for batch in pieces(batches, 2 << 20, column):
                made = _scores(Words(batch.column(column), fold=True), order, total, known, own.levels, own.levels,
                               lambda keys: _told(keys, words, counts))
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in carried], *made], names=names)

        return docs.mapInArrow(rows, extended(docs.select(carried).schema, _SCORED))

    def _exchanged(self, docs: DataFrame, column: str) -> DataFrame:
        """Scores in buckets that ask the segments; an n-gram costs one entry per bucket, however frequent it is."""
        carried = [c for c in docs.columns if c != column]
        total, known, order, bits, segments = self.tokens, self.known, self.order, self.bits, self.segments
        size = docs.agg(F.sum(F.octet_length(column)).alias("s"), F.count("*").alias("n")).first()
        buckets = buckets_for(int(size["s"] or 0) + int(size["n"]), BUCKET_BYTES)
        columns = [f"c{i}" for i in range(len(carried))]
        given = docs.select(F.col(column).alias("text"), *[F.col(c).alias(n) for c, n in zip(carried, columns, strict=True)])
        with shuffles_dropped(self.spark):
            texts, drop = bucketed(given, buckets, "scored")

        def keys_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
            runs = ngrams(words, order)
            longer = np.concatenate([np.zeros(0, np.uint64), *runs[1:]])
            return np.unique(runs[0]), np.unique(longer[longer != 0])

        def asked(t: pa.Table) -> pa.Table:
            words, grams = (dict(split_sorted(k, segments)) | {-1: k} for k in keys_of(Words(t.column("text"), fold=True)))
            at, none = sorted((words.keys() | grams.keys()) - {-1}), slice(0, 0)
            give_back()
            return pa.table({"segment": pa.array(at, pa.int32()), "bucket": pa.array([t.column("bucket")[0].as_py()] * len(at), pa.int32()),
                             "words": pa.array([squeezed(words[-1][words.get(s, none)]) for s in at], pa.binary()),
                             "grams": pa.array([squeezed(grams[-1][grams.get(s, none)], LONG) for s in at], pa.binary())})

        def told(left: pa.Table, right: pa.Table) -> pa.Table:
            held = right.to_pylist()[0] if right.num_rows else {"words": b"", "counts": b"", "bits": b""}
            own = Filter(bits, segments)
            own.segments, own.data = 1, unpacked(held["bits"], np.uint8) if held["bits"] else np.zeros(own.part // 8, dtype=np.uint8)
            known_words, counts = unpacked(held["words"], np.uint64), unpacked(held["counts"], np.int64)
            levels, longer, exact = [], [], []
            for start in range(0, left.num_rows, ASKING):  # only some buckets' n-grams are unpacked at a time
                part = left.slice(start, ASKING)
                words = [spread(v) for v in part.column("words")]
                levels += [packed(v) for v in _probed(own, words)]
                exact += [packed(_told(keys, known_words, counts).astype(np.int64)) for keys in words]
                longer += [packed(v) for v in _probed(own, [spread(v, LONG) for v in part.column("grams")])]
            rows = pa.table({"bucket": left.column("bucket"), "part": left.column("segment"), "levels": pa.array(levels, pa.binary()),
                             "longer": pa.array(longer, pa.binary()), "exact": pa.array(exact, pa.binary())})
            give_back()
            return rows

        def scored(left: pa.Table, right: pa.Table) -> pa.Table:
            right = right.sort_by("part")
            answer = {n: np.concatenate([np.zeros(0, k), *[unpacked(v, k) for v in right.column(n)]])
                      for n, k in (("levels", np.uint8), ("longer", np.uint8), ("exact", np.int64))}
            given = left.combine_chunks()
            # answers come in the order of the keys; only n-grams before a text's start, the key 0, were not asked for
            values = _scores(Words(given.column("text"), fold=True), order, total, known, lambda keys: answer["levels"].astype(np.int64),
                             lambda keys: np.concatenate([np.zeros(len(keys) - len(answer["longer"]), np.int64), answer["longer"]]),
                             lambda keys: answer["exact"])
            rows = pa.Table.from_arrays([*[given.column(n) for n in columns], *values], names=names)
            give_back()
            return rows

        names = [*columns, *[f.split()[0] for f in _SCORED.split(", ")]]
        held = self.table.select("segment", "words", "counts", "bits").groupBy("segment")

        def wave(k: int) -> DataFrame:
            own = (F.col("bucket") >= buckets * k // WAVES) & (F.col("bucket") < buckets * (k + 1) // WAVES)
            requests = texts.select("bucket", "text").where(own).groupBy("bucket").applyInArrow(asked, "segment int, bucket int, words binary, grams binary")
            return staged(requests.groupBy("segment").cogroup(held)
                          .applyInArrow(told, "bucket int, part int, levels binary, longer binary, exact binary"), "levels")

        with shuffles_dropped(self.spark):
            answers = reduce(DataFrame.unionAll, [wave(k) for k in range(WAVES)])
            found = staged(texts.groupBy("bucket").cogroup(answers.groupBy("bucket"))
                           .applyInArrow(scored, extended(texts.select(columns).schema, _SCORED)), "scores")
        drop()
        return found.toDF(*carried, *[f.split()[0] for f in _SCORED.split(", ")])


def op4_log_frequency_bloom(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (remainder("doc_id", 5) == 1).alias("held_out"))
    return Model(docs.where("not held_out"), most_words=0).score(docs)  # one way at every size: through the segments
