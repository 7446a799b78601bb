"""Divergence of sources: how far the terms of each source of a language stray from those of the others.

Texts are factored into whitespace chunks: each task counts the chunks of its documents; a bucket of chunks cuts every
chunk that occurs anywhere into terms once and joins the terms back to the counts; a bucket of terms adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.base import LOWER, UPPER, buckets_for, give_back, packed, pieces, slice_hashes, staged, table, unpacked

#: Fixed value: a term.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed value: what a chunk must hold to have a term.
_TERM_LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"
#: Documents of a language that a term must be in.
LEAST_DOCUMENTS = 3
#: Terms listed per source.
TOP = 200
#: Fixed value: shares are whole numbers of this part.
UNIT = 1_000_000_000

#: Bytes to bytes of terms: letters folded, all other ASCII a space.
_TERM_BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)], dtype=np.uint8)
#: Distinct chunks that a task gathers before it sends them on.
_HELD = 1 << 18
_PIECE_BYTES = 4 << 20
#: Bytes of text whose chunks a bucket gets, on average.
_BUCKET_BYTES = 8 << 20
#: Rows of (source, term) that one task compares, on average.
_BLOCK_ROWS = 1 << 18

_PACKED = ("groups", "lengths", "parts", "n", "documents", "low", "gap")
_FOLDED = "bucket int, langs array<string>, sources array<string>, " + ", ".join(f"{c} binary" for c in _PACKED)
_FOLDED_ARROW = pa.schema([("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())), *[(c, pa.binary()) for c in _PACKED]])
_KEPT = "lang string, source string, term string, count long, lang_count long, lead boolean"


class Counts:
    """Counts of chunks or terms (``parts``) by group: a key is group number x number of parts + part number.

    Beside the occurrences ``n`` stand the documents, as far as it matters: 1, 2, or 3 for three and more, with the
    smallest and the largest of them. Up to two these are all there are, so counts of different places add up
    exactly without a list of documents.
    """

    def __init__(self, groups: list[tuple[str, str]], parts: pa.Array, key, n, documents, low, high):
        self.groups, self.parts = groups, parts
        order = np.argsort(key, kind="stable")
        key, n, documents, low, high = (x[order] for x in (key, n, documents, low, high))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.key = key[first]
        if not len(key):
            self.n, self.documents, self.low, self.high = n, documents, low, high
            return
        size = np.diff(np.append(first, len(key)))
        self.n = np.add.reduceat(n, first)
        self.low, self.high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        least, most = np.repeat(self.low, size), np.repeat(self.high, size)
        third = (documents > 2) | (low != least) & (low != most) | (high != least) & (high != most)
        self.documents = np.where(np.logical_or.reduceat(third, first), 3, np.where(self.low == self.high, 1, 2)).astype(np.uint8)

    @property
    def group(self) -> np.ndarray:
        return self.key // max(1, len(self.parts))

    @property
    def part(self) -> np.ndarray:
        return self.key % max(1, len(self.parts))

    @classmethod
    def joined(cls, rows: list[tuple]) -> Counts:
        """Counts out of rows of (groups, group numbers, parts, n, documents, low, high), those of one key added up."""
        numbers: dict[tuple[str, str], int] = {}
        group = [np.array([numbers.setdefault(g, len(numbers)) for g in groups], dtype=np.int64)[at] if len(at) else at for groups, at, *_ in rows]
        parts = pa.chunked_array([r[2] for r in rows], pa.large_string()).combine_chunks().dictionary_encode()
        codes = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        key = np.concatenate(group) * max(1, len(parts.dictionary)) + codes
        return cls(list(numbers), parts.dictionary, key, *[np.concatenate([r[i] for r in rows]) for i in range(3, 7)])

    def rows(self) -> tuple:
        return self.groups, self.group, self.parts.take(pa.array(self.part)), self.n, self.documents, self.low, self.high

    def packed(self, buckets: int) -> pa.RecordBatch:
        """A row per bucket of parts, with its counts packed and the groups that they are of."""
        bucket = _buckets_of(self.parts, buckets)[self.part] if len(self.key) else np.zeros(0, np.int64)
        order = np.lexsort((self.group, bucket))
        owner, group = bucket[order], self.group[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(owner))[:len(first)]
        data, bounds = _bytes_of(self.parts.take(pa.array(self.part[order])))
        lengths, text = np.diff(bounds).astype(np.uint32), data.tobytes()
        n, documents, low, gap = self.n[order], self.documents[order], self.low[order], (self.high - self.low)[order]
        cut = lambda values: pa.array([packed(values[a:b]) for a, b in zip(first, last, strict=True)], pa.binary())
        langs, sources, codes = [], [], np.zeros(len(owner), np.uint32)
        for a, b in zip(first, last, strict=True):
            own, codes[a:b] = np.unique(group[a:b], return_inverse=True)
            langs.append([self.groups[g][0] for g in own.tolist()])
            sources.append([self.groups[g][1] for g in own.tolist()])
        places = list(zip(bounds[first].tolist(), bounds[last].tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(owner[first], pa.int32()), pa.array(langs, pa.list_(pa.string())), pa.array(sources, pa.list_(pa.string())), cut(codes),
             cut(lengths), pa.array([text[a:b] for a, b in places], pa.binary()), cut(n), cut(documents), cut(low), cut(gap)], schema=_FOLDED_ARROW)

    @classmethod
    def unpacked(cls, t: pa.Table) -> Counts:
        """The counts of packed rows, added up."""
        numbers: dict[tuple[str, str], int] = {}
        owners = [np.array([numbers.setdefault(g, len(numbers)) for g in zip(langs, sources, strict=True)], dtype=np.int64)[unpacked(codes, np.uint32)]
                  for langs, sources, codes in zip(t.column("langs").to_pylist(), t.column("sources").to_pylist(), t.column("groups"), strict=True)]
        flat = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=kind)
        lengths = flat("lengths", np.uint32)
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        texts = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(flat("parts", np.uint8))])
        low = flat("low", np.int64)
        return cls.joined([(list(numbers), np.concatenate(owners), texts, flat("n", np.int64), flat("documents", np.uint8), low, low + flat("gap", np.int64))])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (large strings without nulls) in one array, and where each begins and ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if bounds[-1] else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _buckets_of(texts: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of each text, by a hash of all its bytes."""
    data, bounds = _bytes_of(texts)
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    return (slice_hashes(padded, bounds[:-1], np.diff(bounds)) % np.uint64(buckets)).astype(np.int64)


# Chunks of documents -----------------------------------------------------------------------------------

def _piece_counts(batch: pa.RecordBatch) -> Counts:
    """Counts of the chunks of a piece."""
    codes: dict[tuple[str, str], int] = {}
    pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
    group = np.array([codes.setdefault(p, len(codes)) for p in pairs], dtype=np.int64)
    lists = pc.ascii_split_whitespace(batch.column("text").cast(pa.large_string()))
    owner = np.repeat(np.arange(len(lists)), np.array(pc.list_value_length(lists), dtype=np.int64))
    chunks = lists.flatten().dictionary_encode()
    words, at = chunks.dictionary, chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(words))
    useful = np.array(pc.match_substring_regex(words, _TERM_LETTER), dtype=bool)[at] if len(words) else np.zeros(0, bool)
    per_document, n = np.unique(owner[useful] * size + at[useful], return_counts=True)
    row = per_document // size
    number = batch.column("row").to_numpy()[row]
    return Counts(list(codes), words, group[row] * size + per_document % size, n, np.ones(len(n), np.uint8), number, number)


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The counts of a task's documents, added up over pieces as far as ``_HELD`` distinct chunks allow."""
    held, rows = [], 0
    for piece in pieces(batches, _PIECE_BYTES):
        held.append(_piece_counts(piece).rows())
        rows += len(held[-1][1])
        if rows > _HELD:
            found = Counts.joined(held)
            held, rows = [found.rows()], len(found.key)
            if rows > _HELD // 2:
                yield found.packed(buckets)
                held, rows = [], 0
    if held:
        yield Counts.joined(held).packed(buckets)


# Terms of chunks ---------------------------------------------------------------------------------------

def _terms_of(chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of all chunks and the chunk of each: letters folded, all other bytes turned into spaces and split at."""
    data, bounds = _bytes_of(chunks)
    plain = pa.Array.from_buffers(pa.large_string(), len(chunks), [None, pa.py_buffer(bounds), pa.py_buffer(_TERM_BYTES[data])])
    lists = pc.ascii_split_whitespace(plain)
    sizes, flat = np.array(pc.list_value_length(lists), dtype=np.int64), lists.flatten()
    solid = np.array(pc.binary_length(flat), dtype=np.int64) > 0
    return np.repeat(np.arange(len(chunks)), sizes)[solid], flat.filter(pa.array(solid))


def _chunk_bucket(buckets: int):
    def terms(t: pa.Table) -> pa.Table:
        """A bucket's chunks, each cut into terms once, and the terms joined back to the counts."""
        found = Counts.unpacked(t)
        chunk, flat = _terms_of(found.parts)
        coded = flat.dictionary_encode()
        size = max(1, len(coded.dictionary))
        # Terms of a chunk with how often each is in it, by chunk.
        pair, times = np.unique(chunk * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        starts = np.searchsorted(pair, np.arange(len(found.parts) + 1) * size)
        part = found.part
        sizes = (starts[1:] - starts[:-1])[part]
        rows = np.repeat(np.arange(len(part)), sizes)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[part[rows]]
        joined = Counts(found.groups, coded.dictionary, found.group[rows] * size + pair[at] % size, found.n[rows] * times[at],
                        found.documents[rows], found.low[rows], found.high[rows])
        rows = pa.Table.from_batches([joined.packed(buckets)])
        give_back()
        return rows

    return terms


def _term_bucket(least: int):
    def kept(t: pa.Table) -> pa.Table:
        """The counts of a bucket's terms that ``least`` documents of the language have; ``lead`` marks one row per term."""
        found = Counts.unpacked(t)
        numbers: dict[str, int] = {}
        lang = np.array([numbers.setdefault(g[0], len(numbers)) for g in found.groups], dtype=np.int64)
        size = max(1, len(found.parts))
        key = lang[found.group] * size + found.part if len(found.key) else found.key
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else order
        of = np.empty(len(key), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key)))) if len(key) else order
        # Sources of a language share no document, so their documents add up.
        documents = np.bincount(of, weights=found.documents)[of] if len(key) else found.n
        total = np.zeros(len(first), dtype=np.int64)
        np.add.at(total, of, found.n)
        lead = np.zeros(len(key), dtype=bool)
        lead[order[first]] = True
        at = np.flatnonzero(documents >= least)
        group = found.group[at]
        name = lambda i: pa.array([g[i] for g in found.groups], pa.string()).take(pa.array(group, pa.int64()))
        return pa.table({"lang": name(0), "source": name(1), "term": found.parts.take(pa.array(found.part[at], pa.int64())).cast(pa.string()),
                         "count": found.n[at], "lang_count": total[of[at]], "lead": lead[at]})

    return kept


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """Per (lang, source, term) with occurrences: ``count``, and the language's; terms in ``least`` documents of the language only.

    ``docs`` has row, lang, source, text without nulls; a document is in one task. Each task sends a chunk once or a few
    times, packed by buckets of chunks; a bucket, which holds all counts of its chunks, sends its terms on by
    buckets of terms. A chunk or term that is everywhere costs its bucket about an entry per task and source.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets_for(total, _BUCKET_BYTES)
    chunks = docs.mapInArrow(lambda batches: _counted(batches, buckets), _FOLDED)
    terms = chunks.groupBy("bucket").applyInArrow(_chunk_bucket(buckets), _FOLDED)
    return terms.groupBy("bucket").applyInArrow(_term_bucket(least), _KEPT)


# Shares and divergences --------------------------------------------------------------------------------

def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count, in whole parts of ``UNIT``: 1 + floor(UNIT * (count + 1) / (total + terms)).

    Divided in two steps, so that products stay within a long for totals up to 2.8e14; beyond, Spark raises an error.
    """
    first, second, whole = F.lit(32_000).cast("long"), F.lit(UNIT // 32_000).cast("long"), total + terms
    upper = (count + 1) * first
    return 1 + F.call_function("div", upper, whole) * second + F.call_function("div", upper % whole * second, whole)


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """A row per (lang, source) of ``docs``: its occurrences and terms, those of the language, and the share of a term it lacks."""
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("own_terms"))
    whole = kept.groupBy("lang").agg(F.sum("count").alias("lang_total"), F.count_if("lead").alias("terms"))
    found = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    found = found.fillna(0, ["total", "own_terms", "lang_total", "terms"])
    zero = F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    return found.withColumn("zero", zero)


def _shared_block(t: pa.Table) -> pa.Table:
    """For each pair of sources, over the block's terms that both have: what the four sums of ``pair_divergences`` leave out.

    One source at a time is spread over the terms and meets the rows of all others, so memory follows the rows.
    """
    terms = t.column("term").combine_chunks().dictionary_encode()
    sources = t.column("source").combine_chunks().dictionary_encode()
    owner = sources.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(owner, kind="stable")
    owner, term = owner[order], terms.indices.to_numpy(zero_copy_only=False)[order]
    share, zero = t.column("share").to_numpy()[order], t.column("zero").to_numpy()[order]
    starts = np.searchsorted(owner, np.arange(len(sources.dictionary) + 1))
    far = lambda p, q: (p - q) * (p - q) // q
    lefts, rights, sums = [], [], []
    for a, (start, stop) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        own = np.zeros(len(terms.dictionary), dtype=np.int64)
        own[term[start:stop]] = share[start:stop]
        p = own[term]
        met = np.flatnonzero((p > 0) & (owner != a))
        p, q, q0, p0, other = p[met], share[met], zero[met], zero[start], owner[met]
        value = far(p, q) - far(p, q0) - far(p0, q) + far(p0, q0)
        first = np.flatnonzero(np.concatenate([[True], other[1:] != other[:-1]])) if len(met) else np.zeros(0, np.int64)
        lefts += [a] * len(first)
        rights += other[first].tolist()
        sums += np.add.reduceat(value, first).tolist() if len(first) else []
    names = sources.dictionary
    return pa.table({"lang": pa.repeat(t.column("lang")[0], len(sums)), "source": names.take(pa.array(lefts, pa.int64())),
                     "item": names.take(pa.array(rights, pa.int64())), "value": pa.array(sums, pa.int64())})


def pair_divergences(kept: DataFrame, totals: DataFrame, rows: int) -> DataFrame:
    """The divergence of each source from each other source of its language, over all kept terms.

    A term that a source lacks has one share, so the sum over all terms is: the terms of the one source as if the
    other had none of them, the terms of the other likewise (both from a histogram of shares), all further terms at
    both zero shares, and a correction for terms that both have, summed in blocks of terms. Nothing is spread over
    sources that do not have a term.
    """
    known = kept.join(totals.select("lang", "source", "total", "terms", "zero"), ["lang", "source"])
    known = known.withColumn("share", _share(F.col("count"), F.col("total"), F.col("terms")))
    block = F.pmod(F.xxhash64("term"), F.lit(buckets_for(rows, _BLOCK_ROWS, 1))).alias("block")
    shared = (known.select("lang", "source", "term", "share", "zero", block).groupBy("lang", "block")
              .applyInArrow(_shared_block, "lang string, source string, item string, value long"))
    counted = known.groupBy("lang", "source", "share").agg(F.count(F.lit(1)).alias("times"))
    other = totals.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"), F.col("own_terms").alias("other_terms"))
    met = counted.join(other, "lang").where(F.col("source") != F.col("item"))
    share, zero, times = F.col("share"), F.col("other_zero"), F.col("times")
    # One pass over the histogram serves the pair in both directions.
    both = F.array(F.struct("source", "item", (times * _divergence(share, zero)).alias("value")),
                   F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (times * _divergence(zero, share)).alias("value")))
    single = met.select("lang", F.explode(both).alias("part")).select("lang", "part.*")
    pairs = totals.join(other, "lang").where(F.col("source") != F.col("item"))
    neither = (F.col("terms") - F.col("own_terms") - F.col("other_terms")) * _divergence(F.col("zero"), F.col("other_zero"))
    rest = pairs.select("lang", "source", "item", F.when(F.col("terms") > 0, neither).otherwise(F.lit(0).cast("long")).alias("value"))
    return rest.unionByName(single).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergences(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Terms with a larger share in a source than in its language, and how far it strays."""
    known = kept.join(totals.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    known = known.select("lang", "source", F.col("term").alias("item"), _share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
                         _share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"))
    return known.where(F.col("p") > F.col("q")).select("lang", "source", "item", _divergence(F.col("p"), F.col("q")).alias("value"))


def audited(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Divergence of the sources of each language, from columns text, lang and source of ``docs``; others are not read.

    Returns lang, source, part, item, value, rank: part ``pair`` has a row for each other source of the language, part
    ``term`` the ``top`` terms by which the source strays from its language. ``least`` (1 to 3) documents must hold a
    term. Null text, lang and source are ''. A row is a document, so repeated rows count as often as they occur; ties in
    rank go by the UTF-8 order of the item. A text without terms still gives its (lang, source) group; an empty table
    gives no rows. Chunks of any length are cut whole.
    """
    if not 1 <= least <= 3:
        raise ValueError("least must be from 1 to 3: documents are told apart up to three only")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    plain = docs.select(blank("lang"), blank("source"), blank("text"))
    kept = staged(kept_terms(plain.withColumn("row", F.monotonically_increasing_id()), least), "kept-terms")
    totals = staged(group_totals(plain, kept), "group-totals")
    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df, part: df.withColumns({"part": F.lit(part), "rank": F.row_number().over(first)})
    terms = ranked(term_divergences(kept, totals), "term").where(F.col("rank") <= top)
    return ranked(pair_divergences(kept, totals, kept.count()), "pair").unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audited(table(spark, folder, "documents"))


OP11_SQL = rf"""
with docs as (
    select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as found
    from documents),
occurring as (select row, lang, source, unnest(found) as term from docs),
kept as (
    select lang, term, count(*)::hugeint as lang_count from occurring
    group by lang, term having count(distinct row) >= {LEAST_DOCUMENTS}),
groups as (select distinct lang, source from docs),
sizes as (select lang, count(*)::hugeint as v, sum(lang_count)::hugeint as lang_n from kept group by lang),
own as (select lang, source, term, count(*)::hugeint as n from occurring semi join kept using (lang, term) group by all),
totals as (select lang, source, sum(n)::hugeint as total from own group by all),
shares as (
    select g.lang, g.source, k.term, coalesce(o.n, 0) as n,
        1 + ({UNIT}::hugeint * (coalesce(o.n, 0) + 1)) // (coalesce(t.total, 0) + s.v) as p,
        1 + ({UNIT}::hugeint * (k.lang_count + 1)) // (s.lang_n + s.v) as q
    from groups g join kept k using (lang) join sizes s using (lang)
    left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term
    left join totals t on t.lang = g.lang and t.source = g.source),
pairs as (
    select a.lang, a.source, b.source as item,
        coalesce((select sum((x.p - y.p) * (x.p - y.p) // y.p) from shares x join shares y on x.lang = y.lang and x.term = y.term
                  where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source),
terms as (
    select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value from shares where n > 0 and p > q),
ranked as (
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::integer as rank from pairs
    union all
    select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::integer as rank from terms)
select * from ranked where part = 'pair' or rank <= {TOP}
"""
