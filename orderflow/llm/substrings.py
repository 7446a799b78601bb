"""Removal of repeated passages, which a recompression of the word sequences finds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import Words, bucketed, buckets_for, extended, grams, mix, packed, pieces, table
from orderflow.llm.exchange import SENT, answered, distinct_rows, found_at, id_arrays, known_keys, sent

#: Words of a window, rounds of recompression, text per bucket and per segment.
WINDOW, ROUNDS = 13, 2
BUCKET_BYTES, SEGMENT_BYTES = 3 << 20, 8 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)


class Symbols:
    """The symbols that stand for the words of some texts, after a number of rounds.

    ``name`` is a fingerprint of what a symbol stands for, so equal content has equal names everywhere, without a
    table of names. ``left`` and ``right`` are the words that decide that this symbol stands here:
    wherever those words recur, the symbol does. A symbol that depends on where its text begins or ends
    reaches beyond that edge, so no window holds all it depends on.
    """

    def __init__(self, words: Words):
        n = np.diff(words.begin)
        self.text = np.repeat(np.arange(len(n)), n)
        self.name = words.hash
        self.left = np.arange(len(self.name))
        self.right = self.left + 1
        self.low, self.high = words.begin[:-1] - 1, words.begin[1:] + 1  # beyond each text's edges

    def _neighbours(self):
        """For each symbol, where the one before it begins to depend on words, and the one after it ends to."""
        same = self.text[1:] == self.text[:-1]
        before, after = self.low[self.text], self.high[self.text]
        before[1:][same] = self.left[:-1][same]
        after[:-1][same] = self.right[1:][same]
        return same, before, after

    def runs(self, level: int) -> None:
        """Names each run of one symbol by the symbol and the run's length."""
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        starts = np.flatnonzero(np.concatenate([[True], ~(same & (self.name[1:] == self.name[:-1]))]))
        lengths = np.diff(np.concatenate([starts, [len(self.name)]]))
        ends = starts + lengths - 1
        name = self.name[starts]
        long = lengths > 1
        name[long] = mix(name[long] + mix(lengths[long].astype(np.uint64) * np.uint64(64) + np.uint64(level)))
        self.left, self.right = np.minimum(before[starts], self.left[starts]), np.maximum(after[ends], self.right[ends])
        self.name, self.text = name, self.text[starts]

    def pairs(self, level: int) -> None:
        """Names each pair of a left symbol and a right one after it; a bit of its name says which a symbol is."""
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        is_right = (mix(self.name ^ np.uint64(0xA5A5 + level)) & np.uint64(1)).astype(bool)
        opens = np.zeros(len(self.name), dtype=bool)
        opens[:-1] = same & ~is_right[:-1] & is_right[1:]
        closes = np.concatenate([[False], opens[:-1]])
        first = np.flatnonzero(opens)
        name, left, right = self.name.copy(), self.left.copy(), self.right.copy()
        alone = ~opens & ~closes
        left = np.where(alone & is_right, np.minimum(left, before), left)
        right = np.where(alone & ~is_right, np.maximum(right, after), right)
        name[first] = mix(mix(self.name[first] + np.uint64(level)) * np.uint64(3) + self.name[first + 1])
        left[first] = np.minimum(self.left[first], self.left[first + 1])
        right[first] = np.maximum(self.right[first], self.right[first + 1])
        self.name, self.left, self.right, self.text = name[~closes], left[~closes], right[~closes], self.text[~closes]

    def lowest(self, starts: np.ndarray, width: int, spans: Spans) -> np.ndarray:
        """For windows of words, a fingerprint of the lowest symbol, by scrambled name, that the window alone decides.

        It holds the symbol and all words that decide it. Of equal names in a window the first is taken.
        """
        low = np.searchsorted(self.left, starts)
        high = np.searchsorted(self.right, starts + width, side="right")
        best, where = np.full(len(starts), _NONE), np.full(len(starts), -1)
        key = mix(self.name)
        for k in range(int((high - low).max(initial=0))):
            at = np.minimum(low + k, len(key) - 1)
            better = (low + k < high) & (key[at] < best)
            best, where = np.where(better, key[at], best), np.where(better, at, where)
        found = where >= 0
        at = where[found]
        best[found] = mix(key[at] ^ spans.of(self.left[at], self.right[at]))
        return best


class Spans:
    """Fingerprints of any runs of words, from those of all first words."""

    def __init__(self, words: Words):
        factor, back = (np.cumprod(np.full(len(words.hash) + 1, x, dtype=np.uint64)) for x in (0x9E3779B97F4A7C15, _INVERSE))
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hash * factor[:-1], dtype=np.uint64)])
        self.back = back

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The fingerprint of words left to right, wherever they stand: the factors up to the first word are divided out."""
        return mix((self.total[right] - self.total[left]) * self.back[left])


def window_starts(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word of every window, and its text."""
    n = np.maximum(0, np.diff(words.begin) - width + 1)
    text = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + words.begin[:-1][text], text


def anchors(words: Words, starts: np.ndarray, width: int, rounds: int) -> np.ndarray:
    """A symbol for each window: equal windows have the same, wherever they stand.

    It is the lowest of the symbols of the last round that the window decides by itself; where it decides none (long
    runs may leave it none), the lowest of an earlier round, and at last the window's own fingerprint.
    """
    symbols, levels, spans = Symbols(words), [], Spans(words)
    for level in range(rounds):
        symbols.runs(2 * level)
        symbols.pairs(2 * level + 1)
        levels.append(symbols.lowest(starts, width, spans))
    result = np.full(len(starts), _NONE)
    for found in levels[::-1]:
        result = np.where(result == _NONE, found, result)
    bare = result == _NONE
    result[bare] = fingerprints(words, starts[bare], width)
    return result


def fingerprints(words: Words, starts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of the windows that begin at ``starts``."""
    return grams(words.hash, width)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)


def without_repeats(docs: DataFrame, key: str = "doc_id", column: str = "text", window: int = WINDOW,
                    rounds: int = ROUNDS, with_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept_text``: a word goes if a window that covers it also starts in a
    document with a smaller id. Windows are judged on the input. Kept words are joined by one space.

    1. Each bucket of documents recompresses its word sequences: runs, then pairs, for ``rounds`` rounds. Equal windows
       get the same symbol (``anchors``), one for some five windows. Distinct symbols go to the segment of their range.
    2. A segment tells buckets which symbols two documents share. Only windows with such a symbol go on: their
       fingerprints and smallest ids go to segments, which answer with the smallest id of all.
    3. Each bucket removes what is covered. Windows are compared by 64-bit fingerprints of all their words.

    The texts are shuffled once, into a bucketed table that all three scans read. What buckets and segments
    exchange is packed and distinct per bucket, so a passage in a third of all documents costs one entry per bucket.

    A null text counts as no words, and its ``kept_text`` is empty. A document with a null id keeps all words and
    takes none from others; rows with equal ids take none from each other. A column that has the name of an added
    one is replaced. No rows give no rows.
    """
    added = "n_words long, n_removed long, kept_text string"
    docs = docs.drop(*[f.split()[0] for f in added.split(", ")], "bucket")
    held = int(docs.agg(F.sum(F.octet_length(column)).alias("s")).first()["s"] or 0)
    buckets, segments = buckets_for(held, BUCKET_BYTES), buckets_for(held, SEGMENT_BYTES)
    docs, _ = bucketed(docs, buckets, "passages")
    texts = docs.select("bucket", F.col(key).cast("long").alias("id"), F.col(column).alias("text"))

    def symbols(batches):
        for batch in pieces(batches, BUCKET_BYTES):
            ids, solid = id_arrays(batch.column("id"))
            numbers = np.array(batch.column("bucket"))
            rows = []
            for bucket in np.unique(numbers):
                at = np.flatnonzero(numbers == bucket)
                words = Words(batch.column("text").take(pa.array(at)))
                starts, text = window_starts(words, window)
                found = anchors(words, starts, window, rounds)
                new = np.concatenate([[True], (found[1:] != found[:-1]) | (text[1:] != text[:-1])])[:len(found)]
                new &= solid[at][text]
                rows.extend(distinct_rows(int(bucket), found[new], ids[at][text[new]], segments))
            yield sent([(s, b, k, b"", m) for s, b, k, _, m in rows])

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        known, _ = known_keys(right, False)
        rows = []
        if left.num_rows and len(known):
            ids, solid = id_arrays(left.column("id"))
            words = Words(left.column("text"))
            starts, text = window_starts(words, window)
            wanted = (found_at(anchors(words, starts, window, rounds), known) >= 0) & solid[text]
            rows = list(distinct_rows(left.column("bucket")[0].as_py(), fingerprints(words, starts[wanted], window), ids[text[wanted]], segments))
        return pa.Table.from_batches([sent(rows)])

    shared = answered(texts.mapInArrow(symbols, SENT), False)
    doubled = answered(texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(windows, SENT), True)
    names = [c for c in docs.columns if c not in ("bucket", column)]
    carried = [*names, column] if with_text else names

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        known, low = known_keys(right, True)
        ids, solid = id_arrays(left.column(key).cast(pa.int64()))
        words = Words(left.column(column))
        gone = np.zeros(len(words.hash) + 1, dtype=np.int32)
        if len(known):
            starts, text = window_starts(words, window)
            at = found_at(fingerprints(words, starts, window), known)
            hit = starts[(at >= 0) & solid[text] & (low[at] < ids[text])]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + window, -1)
        keep = np.cumsum(gone[:-1]) == 0
        total = np.concatenate([[0], np.cumsum(keep)])
        left_ = total[words.begin[1:]] - total[words.begin[:-1]]
        made = [pa.array(np.diff(words.begin), pa.int64()), pa.array(np.diff(words.begin) - left_, pa.int64()), _joined(words, keep)]
        return pa.Table.from_arrays([*[left.column(c) for c in carried], *made], names=[*carried, *[f.split()[0] for f in added.split(", ")]])

    schema = extended(docs.select(carried).schema, added)
    return docs.groupBy("bucket").cogroup(doubled.groupBy("bucket")).applyInArrow(removed, schema)


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    data = words.data.copy()
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[words.first[keep]] += 1
    step[words.last[keep]] -= 1
    chosen = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    at = np.flatnonzero(keep)
    text = np.searchsorted(words.begin, at, side="right") - 1
    joint = words.last[at[:-1][text[1:] == text[:-1]]]
    chosen[joint], data[joint] = True, 0x20
    total = np.concatenate([[0], np.cumsum(chosen, dtype=np.int64)])
    buffers = [None, pa.py_buffer(packed(total[words.bounds])), pa.py_buffer(packed(data[chosen]))]
    return pa.Array.from_buffers(pa.large_string(), len(words), buffers).cast(pa.string())


def op8_recompression(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return without_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP8_SQL = r"""
with texts as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
starts as (select r, doc_id, i, array_to_string(words[i:i + 12], ' ') as w
           from (select r, doc_id, words, unnest(range(1, len(words) - 11)) as i from texts)),
firsts as (select w, min(doc_id) as low from starts group by w having min(doc_id) < max(doc_id)),
gone as (select distinct r, i + unnest(range(0, 13)) as p from starts join firsts using (w) where doc_id > low),
places as (select r, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from texts),
left_over as (select r, string_agg(word, ' ' order by p) as kept from places anti join gone using (r, p) group by r),
removed as (select r, count(*) as n_removed from gone group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join left_over using (r) left join removed using (r)
"""
