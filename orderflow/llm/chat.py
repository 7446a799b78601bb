"""Chat formatting: conversations that a log holds as a growing series of snapshots, and their rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.base import table

#: Turns of a conversation that one window partition holds, where turns are numbered one by one.
BLOCK_TURNS = 64


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn its ``place`` in its conversation, from 1, and the ``prefix`` hash of all turns up to it.

    The hash of a prefix is the exclusive-or of a 128-bit hash of each (place, role, text), so it rolls along
    by one operation a turn. Turns stand by number, nulls first, then by role and text. Places and
    hashes are summed up per block of turn numbers first, so no window holds a whole long conversation.
    """
    block = F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS)
    rows = turns.withColumn("conversation", F.struct("conv_id")).withColumn("block", block)
    inside = Window.partitionBy("conversation", "block").orderBy("turn", "role", "text")
    blocks = Window.partitionBy("conversation").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (rows.groupBy("conversation", "block").agg(F.count("*").alias("rows"))
             .withColumn("ahead", F.coalesce(F.sum("rows").over(blocks), F.lit(0))).drop("rows"))
    rows = (rows.withColumn("place", F.row_number().over(inside)).join(ahead, ["conversation", "block"])
            .withColumn("place", F.col("place") + F.col("ahead"))
            .withColumn("low", F.xxhash64("place", "role", "text"))
            .withColumn("high", F.xxhash64("text", F.lit("second"), "role", "place")))
    earlier = (rows.groupBy("conversation", "block").agg(F.bit_xor("low").alias("low0"), F.bit_xor("high").alias("high0"))
               .withColumn("low0", F.bit_xor("low0").over(blocks)).withColumn("high0", F.bit_xor("high0").over(blocks)))
    running = (Window.partitionBy("conversation", "block").orderBy("place")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    zero = F.lit(0).cast("long")
    rolled = [F.bit_xor(c).over(running).bitwiseXOR(F.coalesce(f"{c}0", zero)).alias(c) for c in ("low", "high")]
    return (rows.join(earlier, ["conversation", "block"])
            .select("conversation", "turn", "role", "text", "place", *rolled)
            .withColumn("prefix", F.struct("place", "low", "high")).drop("low", "high"))


def collapse(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to the turns of maximal conversations.

    A conversation goes if its turns are the first turns of a longer one; of equal ones the smallest
    conv_id stays, null first. Adds ``place``, ``n_turns`` and ``n_copies`` (equal conversations, itself included).
    Role and text are compared as they are, a null differing from an empty one; repeated turns count as turns.
    Turns with a null conv_id form one conversation. An empty table gives an empty one; other columns are not read.
    """
    rolled = prefixes(turns.select("conv_id", "turn", "role", "text"))
    narrow = rolled.select("conversation", "place", "prefix")
    ends = narrow.groupBy("conversation").agg(F.max("prefix").alias("prefix"))
    inner = narrow.join(ends.withColumnRenamed("prefix", "end"), "conversation").where("place < end.place")
    inner = inner.select("prefix").distinct()
    maximal = (ends.groupBy("prefix").agg(F.min("conversation").alias("conversation"), F.count("*").alias("n_copies"))
               .join(inner, "prefix", "left_anti")
               .select("conversation", F.col("prefix.place").alias("n_turns"), "n_copies"))
    return rolled.drop("prefix").join(maximal, "conversation").withColumn("conv_id", F.col("conversation.conv_id"))


def render(turns: DataFrame) -> DataFrame:
    """Maximal conversations as one text each, every turn between its role's header and an end mark."""
    turn = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")),
                    F.lit("<|im_end|>\n"))
    parts = F.sort_array(F.collect_list(F.struct("place", turn.alias("turn"))))
    return (turns.groupBy("conversation", "n_turns", "n_copies").agg(parts.alias("parts"))
            .select(F.col("conversation.conv_id").alias("conv_id"), F.col("n_turns").cast("long"), "n_copies",
                    F.concat_ws("", F.transform("parts", lambda p: p["turn"])).alias("rendered")))


def op5_snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return render(collapse(table(spark, folder, "conversations")))


OP5_SQL = r"""
with placed as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
  from conversations),
whole as (
  select conv_id, count(*) as n_turns, list(struct_pack(r := role, t := text) order by place) as turns,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by place) as rendered
  from placed group by conv_id),
kept as (
  select turns, any_value(n_turns) as n_turns, any_value(rendered) as rendered, min(conv_id) as conv_id, count(*) as n_copies
  from whole group by turns),
firsts as (
  select distinct turns[1:n] as turns from (select turns, unnest(range(1, n_turns)) as n from kept))
select conv_id, n_turns::bigint as n_turns, n_copies::bigint as n_copies, rendered from kept k
where not exists (select 1 from firsts f where f.turns = k.turns)
"""
