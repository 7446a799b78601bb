"""Line-first cleaning: lines are judged first, then what is left of a document."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import LOWER, UPPER, Words, extended, grams, pieces, table

#: A line must end like a sentence: one mark, not a row of ! or ?, and closing quotes or brackets after it.
ENDED = r"""(^|[^!?])[.!?…]["'”’»)\]]*[\x20\x09-\x0D]*$"""
#: Marks between the entries of a menu, a table or a trail of links, and symbols strewn among words.
NAVIGATION = r"[|»›•·<>#*$%&]"
#: Phrases of page furniture, in lower case.
BOILERPLATE = ("javascript", "cookie", "terms of use", "privacy policy", "lorem ipsum", "click here", "read more",
               "sign in", "log in", "subscribe to", "share this", "skip to content", "back to top")
#: A line goes when 100 * marks >= this * words, a document when its lines keep less than this share of its words.
NAVIGATION_PERCENT, KEPT_PERCENT = 30, 40

_FOLD = str.maketrans(UPPER, LOWER)
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def line_judge():
    """A function that says whether a line is kept: it ends like a sentence and is neither menu nor furniture."""
    ended, marks = re.compile(ENDED).search, re.compile(NAVIGATION).findall
    furniture = re.compile("|".join(map(re.escape, BOILERPLATE))).search

    def keep(line: str) -> bool:
        return (ended(line) is not None and furniture(line.translate(_FOLD)) is None
                and 100 * len(marks(line)) < NAVIGATION_PERCENT * max(1, len(re.findall(r"[^\x20\x09-\x0D]+", line))))

    return keep


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(words: Words) -> list[int]:
    """Per text the words inside 3-word windows that the text holds twice or more."""
    result = []
    for i in range(len(words)):
        windows = grams(words.hash[words.of(i)], 3)
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        covered = np.zeros(len(windows) + 2, dtype=bool)
        for k in range(3):
            covered[k:k + len(windows)] |= twice
        result.append(int(covered.sum()) if len(windows) else 0)
    return result


_ADDED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_line_words long, "
          "clean_text string, base_failed boolean, kept boolean")


def clean(docs: DataFrame, column: str = "text", with_text: bool = True) -> DataFrame:
    """``docs`` with counts, the text of the kept lines as ``clean_text``, and the verdict ``kept``.

    Lines are judged first (``line_judge``); then a document is rejected if the base rule fails (under 50 words,
    or over half of them in repeated 3-word windows) or if the kept lines hold less than ``KEPT_PERCENT`` of its
    words. Null counts as no text: no words, rejected, ``clean_text`` null. Columns that have the name of an added
    one are replaced. Each row is judged by itself and wholly, however long; windows are compared by 64-bit
    fingerprints within one text. An empty table gives an empty one.
    """
    added = [f.split()[0] for f in _ADDED.split(", ")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    carried = docs.columns if with_text else [c for c in docs.columns if c != column]
    given = added if with_text else [a for a in added if a != "clean_text"]
    schema = extended(docs.select(carried).schema, ", ".join(f for f in _ADDED.split(", ") if f.split()[0] in given))

    def rows(batches):
        keep = line_judge()
        for batch in pieces(batches, 4 << 20, column):
            texts = batch.column(column)
            words = Words(texts)
            n = np.diff(words.begin)
            solid = (words.data & 0xC0) != 0x80
            solid &= ~np.isin(words.data, np.frombuffer(_BLANK.encode(), dtype=np.uint8))
            doubles, left, cleaned = [], [], []
            for text in texts.to_pylist():
                lines = [x for x in (text or "").split("\n") if x.strip(_BLANK)]
                good = [x for x in lines if keep(x)]
                doubles.append(len(lines) - len(set(lines)))
                cleaned.append(None if text is None else "\n".join(good))
            left = np.diff(Words(pa.array(cleaned, pa.large_string())).begin)
            repeats = np.array(_repeated(words), dtype=np.int64)
            failed = (n < 50) | (100 * repeats > 50 * n)
            made = {"n_words": n, "word_chars": _sums(solid, words.bounds), "n_symbols": _sums(_SYMBOL[words.data], words.bounds),
                    "n_dup_lines": doubles, "n_repeat_words": repeats, "n_line_words": left, "clean_text": cleaned,
                    "base_failed": failed, "kept": ~failed & (100 * left >= KEPT_PERCENT * n)}
            arrays = [pa.array(made[f.name], {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(),
                                              "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in schema.fields[len(carried):]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *arrays], names=[f.name for f in schema])

    return docs.mapInArrow(rows, schema)


def op2_line_first_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return clean(table(spark, folder, "documents").select("doc_id", "text"), with_text=False)


OP2_SQL = (r"""
with texts as (select row_number() over () as r, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
lines as (
  select r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
  from (select r, unnest(string_split(coalesce(text, ''), chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
judged as (
  select *, regexp_matches(line, '""" + ENDED.replace("'", "''") + r"""')
    and not regexp_matches(lower(line), '""" + "|".join(BOILERPLATE) + r"""')
    and 100 * len(regexp_extract_all(line, '""" + NAVIGATION + f"""')) < {NAVIGATION_PERCENT} * n as good
  from lines),
by_line as (
  select r, count(*) - count(distinct line) as n_dup_lines, coalesce(sum(n) filter (where good), 0) as n_line_words from judged group by r),
windows as (
  select r, i, count(*) over (partition by r, w1, w2, w3) as n
  from (select r, i, words[i] as w1, words[i + 1] as w2, words[i + 2] as w3
        from (select r, words, unnest(range(1, len(words) - 1)) as i from texts))),
repeats as (
  select r, count(distinct p) as n_repeat_words
  from (select r, i + unnest([0, 1, 2]) as p from windows where n > 1) group by r),
counted as (
  select t.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         coalesce(n_line_words, 0)::bigint as n_line_words
  from texts t left join by_line using (r) left join repeats using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * n_line_words >= {KEPT_PERCENT} * n_words as kept
from counted
""")
