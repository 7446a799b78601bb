"""Mixing of sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.base import n_words, table

#: Weights of sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and the most copies of a source.
SHARE, MOST = 1.5, 2.0
#: Rows that a window's partition holds on average at most.
PIECE_ROWS = 50_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target): words wanted of each source.

    Sources in code-point order, null last, weigh ``weights``, repeating. Together they get ``share`` of
    all words; a target stops at ``most`` times its source's size, and what is above is shared again by
    weight. The level at which that ends is found by one pass over the sources in the order in which they
    fill up. The windows run over one row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filling = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return (sizes.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", weight)
            .withColumn("most", F.col("source_size") * F.lit(float(most)))
            .withColumn("fills_at", F.col("most") / F.col("weight"))
            .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("full", F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("open", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
            # with every source before this one full, the level that the others would reach; beyond the true one it falls
            .withColumn("level", (F.col("wanted") - F.coalesce("full", F.lit(0.0))) / F.col("open"))
            .withColumn("level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything))
            .select("source", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("level"), "most"))
                    .alias("target")))


def _class(size: Column) -> Column:
    """Documents of like size: the number of binary digits and the two after the first."""
    digits = F.length(F.bin(size))
    upper = F.conv(F.substring(F.bin(size), 2, 2), 2, 10)
    return F.coalesce(F.when(size < 4, size).otherwise(digits * 4 + upper.cast("int")).cast("int"), F.lit(0))


def copies(docs: DataFrame, key: Column, pieces: int | None = None, text: str = "text", source: str = "source",
           **rule) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    A document's expected copies are target / size of its source. Within a source, documents stand by size
    class and then by the MD5 digest of ``key``; the expected copies are summed up in that order, the
    source's offset is added, and a document is copied once per whole number that the sum passes. The offset
    is the start of the MD5 digest of the source's name, so reruns agree.

    The running sum is built from counts per (source, size class, piece of the digest's range), so no window
    holds a whole source: a piece has about ``PIECE_ROWS`` rows. Rows that agree in source, size and ``key``
    get the copies of as many neighbouring places, in any order.

    A null text or one without words has size 0 and still takes part; a null source is a source of its own.
    A source of size 0 has target 0. An empty table gives an empty one. Other columns stay as they are.
    """
    sized = (docs.withColumn("mix_size", n_words(F.col(text)))
             .withColumn("mix_digest", F.md5(F.coalesce(key.cast("string"), F.lit("")))))
    if pieces is None:
        pieces = max(1, -(-docs.count() // PIECE_ROWS))
    digest_part = F.floor(F.conv(F.substring("mix_digest", 1, 8), 16, 10).cast("double") / 2**32 * pieces)
    sized = (sized.withColumn("mix_class", _class(F.col("mix_size"))).withColumn("mix_piece", F.coalesce(digest_part.cast("int"), F.lit(0)))
             .withColumn("mix_source", F.struct(F.col(source).alias("name"))))
    counts = sized.groupBy("mix_source", "mix_class", "mix_piece").agg(
        F.count("*").alias("rows"), F.sum("mix_size").alias("words"))
    targets = source_targets(counts.groupBy(F.col("mix_source.name").alias("source"))
                             .agg(F.sum("words").alias("source_size")), **rule)
    targets = targets.select(F.struct(F.col("source").alias("name")).alias("mix_source"),
                             F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    earlier = Window.partitionBy("mix_source").orderBy("mix_class", "mix_piece")
    before = (counts.withColumn("mix_before", F.sum("rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
              .drop("rows", "words").join(targets, "mix_source"))
    inside = Window.partitionBy("mix_source", "mix_class", "mix_piece").orderBy("mix_digest", key)
    name = F.coalesce(F.col("mix_source.name"), F.lit(""))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 2**32
    each = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    return (sized.withColumn("mix_place", F.row_number().over(inside))
            .join(before, ["mix_source", "mix_class", "mix_piece"])
            .withColumn("mix_place", F.coalesce("mix_before", F.lit(0)) + F.col("mix_place"))
            .withColumn("mix_copies", (F.floor(F.col("mix_place") * each + offset)
                                       - F.floor((F.col("mix_place") - 1) * each + offset)).cast("int"))
            .select(*[docs[c] for c in docs.columns], "mix_size", "mix_source_size", "mix_target", "mix_copies"))


def mixed(docs: DataFrame, key: Column, **rule) -> DataFrame:
    """The mix itself: each document as often as ``copies`` says, with the columns of ``docs``."""
    return (copies(docs, key, **rule).where("mix_copies > 0")
            .withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_copies"))).select(*docs.columns))


def op10_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return copies(docs, F.col("doc_id")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
        F.col("mix_copies").alias("copies"))


OP10_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as digest
  from documents),
classed as (
  select *, case when size < 4 then size else length(bin(size)) * 4 + substr(bin(size), 2, 1)::int * 2 + substr(bin(size), 3, 1)::int end as class from sized),
sources as (
  select source, sum(size)::double as source_size, row_number() over (order by source nulls last) - 1 as place
  from classed group by source),
weighed as (
  select *, [5.0::double, 2.0::double, 1.0::double][(place % 3 + 1)::int] as weight, 2.0::double * source_size as most from sources),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(most) over (
             order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by most / weight, source nulls last rows between current row and unbounded following) as reach
  from weighed),
targets as (
  select source, source_size, least(most, coalesce(weight * (max(case when reach <= most / weight then reach end) over ()), most)) as target
  from levels),
placed as (
  select *, row_number() over (partition by source order by class, digest, doc_id) as place from classed),
each as (
  select p.doc_id, p.size, t.source_size::bigint as source_size, t.target, p.place,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as e,
         ('0x' || substr(md5(coalesce(p.source, '')), 1, 8))::ubigint::double / 4294967296 as o
  from placed p join targets t on p.source is not distinct from t.source),
taken as (
  select *, (floor(place * e + o) - floor((place - 1) * e + o))::int as copies from each)
select doc_id, size, source_size, target, (size * copies)::bigint as taken, copies from taken
"""
