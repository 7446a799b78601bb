"""Fill-in-middle: texts cut at two code points and put together in another order.

Cuts are counted in code points, texts are UTF-8 bytes. A learned index over the offsets of all code points of a piece
of texts leads from the one to the other: line segments of bounded error predict an offset, stored residuals correct it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import pieces, table

#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts, those from here on stay plain; of the others, those below go suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
#: Most that a segment's prediction may miss an offset by, so that a residual is one byte.
ERROR = 127

_PIECE_BYTES = 2 << 20
_WIDEST = 1 << 16


class RankIndex:
    """Offsets by rank: error-bounded line segments and a residual for each offset.

    ``offsets`` ascend. A segment runs from one of them to another, and its line predicts those between in whole
    numbers. Segments start ``_WIDEST`` ranks wide; those that miss by more than ``error`` are halved until none does
    (a segment of one rank misses by nothing).
    """

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        size = len(offsets) - 1
        self.residuals = np.zeros(size + 1, dtype=np.int8 if error < 128 else np.int64)
        starts = np.arange(0, size, _WIDEST)
        stops = np.append(starts[1:], size) if len(starts) else starts
        found = [np.zeros(0, dtype=np.int64)]
        while len(starts):
            wide = stops - starts
            first = np.cumsum(wide) - wide
            ranks = np.arange(int(wide.sum())) + np.repeat(starts - first, wide)
            step = ranks - np.repeat(starts, wide)
            missed = offsets[ranks] - np.repeat(offsets[starts], wide) - step * np.repeat(offsets[stops] - offsets[starts], wide) // np.repeat(wide, wide)
            fits = np.maximum.reduceat(np.abs(missed), first) <= error
            within = np.repeat(fits, wide)
            self.residuals[ranks[within]] = missed[within]
            found.append(starts[fits])
            starts, stops = starts[~fits], stops[~fits]
            middle = (starts + stops) // 2
            starts, stops = np.concatenate([starts, middle]), np.concatenate([middle, stops])
        self.knots = np.append(np.sort(np.concatenate(found)), size)
        self.heights = offsets[self.knots]

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of some ranks: the segment's prediction and the residual."""
        at = np.maximum(np.minimum(np.searchsorted(self.knots, ranks, side="right") - 1, len(self.knots) - 2), 0)
        end = np.minimum(at + 1, len(self.knots) - 1)
        wide = np.maximum(self.knots[end] - self.knots[at], 1)
        return self.heights[at] + (ranks - self.knots[at]) * (self.heights[end] - self.heights[at]) // wide + self.residuals[ranks]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, null as empty, and where each text begins and ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if bounds[-1] else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def cut(texts: pa.Array, keys: list, salt: str = "1:", plain_from: int = PLAIN_FROM, suffix_first: int = SUFFIX_FIRST,
        marks: tuple[str, str, str] = MARKS) -> pa.RecordBatch:
    """n, form, prefix_chars, middle_chars and output of each text; ``keys`` choose cuts and forms."""
    data, bounds = _bytes_of(texts)
    offsets = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data)).astype(np.int64)
    index = RankIndex(offsets)
    base = np.searchsorted(offsets, bounds)
    sizes = np.diff(base)
    choice = np.array([np.frombuffer(hashlib.sha256(f"{salt}{'' if k is None else k}".encode()).digest()[:16], dtype=">u4") for k in keys],
                      dtype=np.int64).reshape(-1, 4)
    cuts = np.sort(choice[:, :2] % (sizes + 1)[:, None], axis=1)
    places = index.offsets((cuts + base[:-1, None]).ravel()).reshape(-1, 2).tolist()
    p, s, m = (mark.encode() for mark in marks)
    whole, edges = data.tobytes(), bounds.tolist()
    forms, outputs = [], []
    for i, (first, second) in enumerate(places):
        text = whole[edges[i]:edges[i + 1]]
        if not text or p in text or s in text or m in text or choice[i, 2] % 100 >= plain_from:
            forms.append("plain")
            outputs.append(text)
            continue
        prefix, middle, suffix = whole[edges[i]:first], whole[first:second], whole[second:edges[i + 1]]
        if choice[i, 3] % 100 < suffix_first:
            forms.append("spm")
            outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(forms, pa.string()), pa.array(cuts[:, 0], pa.int64(), mask=plain),
         pa.array(cuts[:, 1] - cuts[:, 0], pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
        names=["n", "form", "prefix_chars", "middle_chars", "output"])


def transformed(docs: DataFrame, key: str = "doc_id", column: str = "text", salt: str = "1:", plain_from: int = PLAIN_FROM,
                suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Texts in fill-in-middle form: ``key``, n, form, prefix_chars, middle_chars, output.

    Only ``key`` and ``column`` are read, so other columns, whatever their names, neither clash nor come along. Null is
    an empty text, which stays plain, as does a text that holds a mark. Equal keys (null among them, taken as '')
    choose alike, so repeated rows give repeated rows; an empty table gives an empty one. Each text is cut by itself: nothing is
    shuffled, and memory follows the longest text.
    """
    def rows(batches):
        for batch in pieces(batches, _PIECE_BYTES):
            made = cut(batch.column("text"), batch.column("key").to_pylist(), salt, plain_from, suffix_first, marks)
            yield pa.RecordBatch.from_arrays([batch.column("key"), *made.columns], names=["key", *made.schema.names])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    made = docs.select(F.col(key).alias("key"), F.col(column).alias("text")).mapInArrow(
        rows, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from, told from output and form alone."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in marks))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .otherwise(F.concat(parts[2], parts[3], parts[1])))


def op12_learned_rank_infill(spark: SparkSession, folder: str) -> DataFrame:
    made = transformed(table(spark, folder, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP12_SQL = f"""
with texts as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n,
        sha256('1:' || coalesce(doc_id::varchar, '')) as hex from documents),
chosen as (
    select *, [('0x' || substr(hex, 8 * i + 1, 8))::bigint for i in range(4)] as h from texts),
placed as (
    select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
        case when n = 0 or contains(text, '{MARKS[0]}') or contains(text, '{MARKS[1]}') or contains(text, '{MARKS[2]}')
            or h[3] % 100 >= {PLAIN_FROM} then 'plain' when h[4] % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form from chosen),
parts as (
    select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1, n - b) as suffix from placed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '{MARKS[0]}' || prefix || '{MARKS[1]}' || suffix || '{MARKS[2]}' || middle
        else '{MARKS[1]}' || suffix || '{MARKS[0]}' || prefix || '{MARKS[2]}' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""
