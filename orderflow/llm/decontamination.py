"""Benchmark decontamination: test passages found in documents by an Aho-Corasick automaton.

Items become windows of words; the automaton's letters spell numbers of words, two to a word, so its memory follows
the benchmark's words and not their length. A document is spelt the same way and read once per automaton; there is
one automaton unless the benchmark is larger than a worker should hold.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import LOWER, UPPER, buckets_for, kept, pieces, staged, table

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: Bytes of normalised items that one automaton holds, on average: about 100 MB of states a worker.
BLOCK_BYTES = 1 << 19
#: Fixed value: a run of characters outside words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_SECTION = 512
_PIECE_BYTES = 8 << 20
#: Bytes of a text to bytes of its words, lower case, and spaces.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


class Automaton:
    """All windows of some items' sections, and the items each window is of."""

    def __init__(self, sections: list[tuple[str, str]], window: int):
        classes: dict[bytes, set[str]] = {}
        for words, item in sections:
            classes.setdefault(words.encode(), set()).add(item)
        vocabulary = sorted({w for words in classes for w in words.split(b" ")})
        self.side = max(1, int(np.ceil(np.sqrt(len(vocabulary)))))
        #: Letters of a number: its upper and lower part, from two alphabets, so that a match starts at a word.
        self.letters = {w: chr(0x100 + i // self.side) + chr(0x10000 + i % self.side) for i, w in enumerate(vocabulary)}
        self.items = [sorted(found) for found in classes.values()]
        owners: dict[str, list[int]] = {}
        for number, words in enumerate(classes):
            spelt = [self.letters[w] for w in words.split(b" ")]
            for at in range(max(1, len(spelt) - window + 1)):
                owners.setdefault("".join(spelt[at:at + window]), []).append(number)
        self.states = ahocorasick.Automaton()
        for spelling, numbers in owners.items():
            self.states.add_word(spelling, (len(spelling) // 2, numbers))
        if owners:
            self.states.make_automaton()

    def read(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of words inside windows, as first and end, and the items that have one."""
        if not self.items:
            return [], set()
        get = self.letters.get
        spelt = "".join([get(w, "\0\0") for w in words])
        stretches: list[tuple[int, int]] = []
        found: set[int] = set()
        for last, (length, numbers) in self.states.iter(spelt):
            end = (last + 1) // 2
            first = end - length
            while stretches and stretches[-1][1] >= first:
                first = min(first, stretches.pop()[0])
            stretches.append((first, end))
            found.update(numbers)
        return stretches, set(itertools.chain.from_iterable(self.items[n] for n in found))


def _joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in their order, those that touch or overlap as one."""
    result: list[tuple[int, int]] = []
    for first, end in sorted(stretches):
        if result and result[-1][1] >= first:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((first, end))
    return result


def _places(text: bytes, normal: bytes, stretches: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Stretches with the code points of the original text from which and to which they run."""
    if not stretches:
        return []
    spans = [m.span() for m in _WORD.finditer(normal)]
    points = np.append(0, np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))
    return [{"first": a, "last": b, "start": int(points[spans[a][0]]), "stop": int(points[spans[b - 1][1]])} for a, b in stretches]


_HIT = "array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>"
_HIT_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _read(docs: DataFrame, sections: list[tuple[str, str]], window: int) -> DataFrame:
    """``docs`` (key, text, n_words, spans, items) after a reading by the automaton of ``sections``."""
    shared, name = docs.sparkSession.sparkContext.broadcast(sections), uuid.uuid4().hex

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = kept("automata", dict)
        if name not in store:  # a worker holds the latest automaton only
            store.clear()
            store[name] = Automaton(shared.value, window)
        own = store[name]
        for batch in pieces(batches, _PIECE_BYTES):
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            sizes, spans, items = [], [], []
            for value, old, known in zip(texts, batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                text = value.as_py()
                normal = text.translate(_NORMAL)
                words = normal.split()
                stretches, found = own.read(words)
                sizes.append(len(words))
                if stretches and old:
                    stretches = _joined(stretches + [(h["first"], h["last"]) for h in old])
                spans.append(_places(text, normal, stretches) if stretches else old)
                items.append(sorted(found.union(known)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text"), pa.array(sizes, pa.int64()), pa.array(spans, _HIT_ARROW),
                 pa.array(items, pa.list_(pa.string()))], names=["key", "text", "n_words", "spans", "items"])

    return docs.mapInArrow(rows, docs.schema)


def item_sections(items: DataFrame, window: int, key: str, column: str) -> DataFrame:
    """Normalised items, cut into sections that share ``window`` - 1 words, so that no window is lost."""
    normal = F.trim(F.regexp_replace(F.translate(F.coalesce(F.col(column), F.lit("")), UPPER, LOWER), GAP, " "))
    split = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), normal.alias("normal")).where("normal <> ''")
    words = F.split("normal", " ")
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - window, F.lit(0)), F.lit(_SECTION))
    part = F.array_join(F.slice(words, F.col("at") + 1, _SECTION + window - 1), " ")
    return split.withColumn("at", F.explode(starts)).select(part.alias("words"), "item")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", column: str = "text",
                 item_key: str = "item_id", item_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Where documents hold windows of items: ``key``, text, n_words, spans, items.

    ``spans`` are the longest stretches of words inside windows: their first word, the word after the last, and the code
    points from ``start`` to before ``stop`` of the original text. ``items`` are the ids (as text, sorted) of items with a
    window there. Items beyond ``block_bytes`` are dealt over several automata, which read the documents one after
    another; each is broadcast and bounded, and the result does not depend on how many there are. Items with
    equal words share their windows, so copies of an item cost an id each.

    Only ``key`` and ``column`` of ``docs`` are read, so clashing names of others do no harm. Null text has no words and
    no spans; a null item text has no window, a null item id is ''. Rows with one item id are one item. Repeated
    documents give repeated rows. An empty benchmark finds nothing, an empty table gives an empty one.
    """
    sections = item_sections(items, window, item_key, item_column)
    total = sections.agg(F.sum(F.octet_length("words") + F.octet_length("item"))).first()[0] or 0
    blocks = buckets_for(total, block_bytes, 1)
    dealt = sections.withColumn("block", F.pmod(F.xxhash64("words", "item"), F.lit(blocks)))
    found = docs.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
                        F.array().cast(_HIT).alias("spans"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        if block:
            found = staged(found, "decontaminated")
        found = _read(found, [tuple(r) for r in dealt.where(F.col("block") == block).select("words", "item").collect()], window)
    return found.withColumnRenamed("key", key)


def op13_automaton_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


OP13_SQL = rf"""
with item_words as (
    select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark),
windows as (
    select distinct item, array_to_string(words[pos:pos + {WINDOW - 1}], ' ') as words, least(len(words), {WINDOW}) as length
    from (select item, words, unnest(range(1, greatest(len(words) - {WINDOW - 1}, 1) + 1)) as pos from item_words where len(words) > 0)),
docs as (
    select row_number() over () as row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
runs as (
    select row, pos, length, array_to_string(words[pos:pos + length - 1], ' ') as words
    from (select row, words, length, unnest(range(1, len(words) - length + 2)) as pos
          from docs, (select distinct length from windows) where len(words) >= length)),
met as (select r.row, r.pos, r.length, w.item from runs r join windows w on r.words = w.words and r.length = w.length),
hits as (
    select row, count(distinct place)::bigint as n_hit
    from (select row, unnest(range(pos, pos + length)) as place from (select distinct row, pos, length from met)) group by row),
found as (select row, count(*)::bigint as n_items, string_agg(item, ',' order by item) as items from (select distinct row, item from met) group by row)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row) left join found using (row)
"""
