"""A corpus pipeline: language, near duplicates, repeated passages, mixing, tokens.

``STAGES`` names the stages in their order; each takes (spark, docs, folder) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, language, mixing, ngram_join, substrings
from orderflow.llm.base import staged, table

#: A document is rejected if its language cannot be told, or is told with less than this score.
LEAST_SCORE = 0.2

#: No stage but mixing can be expressed in SQL; the pipeline is tested against the operators' brute-force versions.
ORACLE_SQL = None


#: The columns that stages work on. Any others ride along as one struct, whatever their names.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = "_other_columns"


def aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of ``docs``, with columns other than ``COLUMNS`` out of its sight and back in their place after it."""
    others = [c for c in docs.columns if c not in COLUMNS]
    plain = [F.col(c) for c in docs.columns if c in COLUMNS]
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    if not others:
        return work(docs).select(docs.columns)
    made = work(docs.select(*plain, F.struct(*[F.col(quoted(c)) for c in others]).alias(_OTHERS)))
    return made.select([F.col(_OTHERS)[c].alias(c) if c in others else F.col(c) for c in docs.columns])


def identify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejects documents without a language: null text, no letter, or a score under ``LEAST_SCORE``.

    The classifiers learn from the labelled documents of this stage's input. The label stays as it was.
    """
    model = language.fit(docs, order=F.col("doc_id"))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return aside(docs, lambda rows: language.predict(rows, model).where(known))


def keep_one(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps, of each group of near duplicates, the document with the smallest id, null last (the first row, if ids repeat)."""
    def firsts(given: DataFrame) -> DataFrame:
        rows = staged(ngram_join.numbered(given), "numbered")  # stored, so that a row keeps its number in every scan
        found = ngram_join.groups(rows.select("row", "doc_id", "text"))
        first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
        return rows.join(first.select("first.row"), "row", "left_semi")

    return aside(docs, firsts)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts passages that a document with a smaller id holds too; every document stays."""
    kinds, removed = dict(docs.dtypes), F.col("n_removed") > 0

    def without(rows: DataFrame) -> DataFrame:
        cut = substrings.without_repeats(rows)
        new = {"text": F.when(removed, F.col("kept_text")).otherwise(F.col("text"))}
        if "n_chars" in kinds:
            new["n_chars"] = F.when(removed, F.length("kept_text")).otherwise(F.col("n_chars")).cast(kinds["n_chars"])
        return cut.select([new[c].alias(c) if c in new else F.col(c) for c in rows.columns])

    return aside(docs, without)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their target weights."""
    return aside(docs, lambda rows: mixing.mixed(rows, F.col("doc_id")))


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, by the multilingual byte-level vocabulary."""
    path, pattern = bpe.vocabulary()
    return bpe.encoded(docs.select("doc_id", "lang", "source", "text"), path, pattern).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("language", identify), ("near_duplicates", keep_one), ("passages", cut_repeats), ("mix", mix), ("tokens", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's rows: one per document and copy that the mix holds."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
