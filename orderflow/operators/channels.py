"""Sales channel lookup, overrides for web orders and unmapped orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.operators.dedupe import dedupe_by, dedupe_rows
from orderflow.operators.quality import REASON
from orderflow.operators.shape import rename_old
from orderflow.operators.skew import plain_join
from orderflow.sources.scratch import staged

NULL_TOKEN = "Unknown"
CHANNEL_VALUES = ["Channel_Id", "Source", "Channel", "Fulfilment_Mode"]
_CHANNEL, _TYPE = "_channel_key", "_type_key"


def match_text(text: Column, case_sensitive: bool = True, null_token: str = NULL_TOKEN) -> Column:
    """Trimmed lookup text in which null and the null token are the same."""
    t = F.coalesce(F.trim(text), F.lit(null_token))
    return t if case_sensitive else F.lower(t)


def shown_text(text: Column, null_token: str = NULL_TOKEN) -> Column:
    """Trimmed text with the null token turned into null."""
    return F.nullif(F.trim(text), F.lit(null_token))


def channel_table(lookup: DataFrame, dimension: DataFrame, case_sensitive: bool = True,
                  null_token: str = NULL_TOKEN) -> DataFrame:
    """Lookup and dimension as one table, unique on the two match texts.

    Where the lookup repeats a pair, the lowest channel id is taken.
    """
    keys = lookup.select(match_text(F.col("Sales_Channel_Map"), case_sensitive, null_token).alias(_CHANNEL),
                         match_text(F.col("Order_Type_Map"), case_sensitive, null_token).alias(_TYPE),
                         F.col("Channel_Id").cast("string").alias("Channel_Id"))
    keys = dedupe_by(keys, [_CHANNEL, _TYPE], [F.col("Channel_Id").try_cast("bigint").asc_nulls_last()])
    rows = dimension.select(F.col("Mapping_Channel_Id").cast("string").alias("Channel_Id"),
                            "Source", "Channel", "Fulfilment_Mode")
    return keys.join(dedupe_by(rows, ["Channel_Id"]), "Channel_Id", "left").select(_CHANNEL, _TYPE, *CHANNEL_VALUES)


def _looked_up(df: DataFrame, lookup: DataFrame, dimension: DataFrame, case_sensitive: bool,
               null_token: str) -> DataFrame:
    # written, so that Spark knows how small it is and sends it to the orders; else all of them would shuffle
    table = staged(channel_table(lookup, dimension, case_sensitive, null_token), "channel-table")
    channel, kind = F.col("Enriched_Sales_Channel"), F.col("Enriched_Order_Type")
    keyed = df.withColumns({_CHANNEL: match_text(channel, case_sensitive, null_token),
                            _TYPE: match_text(kind, case_sensitive, null_token),
                            "Enriched_Sales_Channel": shown_text(channel, null_token),
                            "Enriched_Order_Type": shown_text(kind, null_token)})
    return plain_join(keyed, table, [_CHANNEL, _TYPE]).drop(_CHANNEL, _TYPE)


def map_channels(df: DataFrame, lookup: DataFrame, dimension: DataFrame, case_sensitive: bool = True,
                 null_token: str = NULL_TOKEN) -> DataFrame:
    """Adds channel id, source, channel and fulfilment mode by channel and order type."""
    return _looked_up(df, lookup, dimension, case_sensitive, null_token)


def override_channels(df: DataFrame, exceptions: DataFrame, dimension: DataFrame, precedence: str = "new",
                      case_sensitive: bool = True, null_token: str = NULL_TOKEN) -> DataFrame:
    """Looks web orders up again in the exceptions; other orders stay as they are.

    ``precedence`` says whether the ``new`` or the ``old`` value is taken where both exist.
    """
    if precedence not in ("new", "old"):
        raise ValueError("precedence is 'new' or 'old'")
    again = _looked_up(rename_old(df, CHANNEL_VALUES), exceptions, dimension, case_sensitive, null_token)
    web = F.col("WeborderNo").isNotNull()

    def chosen(name: str) -> Column:
        new, old = F.when(web, F.col(name)), F.col("Old_" + name)
        return F.coalesce(new, old) if precedence == "new" else F.coalesce(old, new)

    return again.withColumns({c: chosen(c) for c in CHANNEL_VALUES}).drop(*["Old_" + c for c in CHANNEL_VALUES])


def is_unmapped() -> Column:
    return F.col("Source").isNull() & F.col("Channel").isNull() & F.col("Fulfilment_Mode").isNull()


def split_unmapped(df: DataFrame, strict_reference: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mapped orders and orders to set aside.

    By default both sides use one rule, so each order is in exactly one of them.
    ``strict_reference`` keeps orders that have an id but no dimension row in both.
    """
    unmapped = is_unmapped()
    kept = F.col("Channel_Id").isNotNull() if strict_reference else ~unmapped
    return df.filter(kept), df.filter(unmapped).withColumn(REASON, F.lit("unmapped_channel"))


def missing_combinations(df: DataFrame) -> DataFrame:
    """The distinct source, type and id of unmapped orders, for a report."""
    return df.filter(is_unmapped()).select("OrderSource", "OrderType", "Channel_Id").distinct()


def combination_channels(df: DataFrame, order_combinations: DataFrame, channel_combinations: DataFrame,
                         ) -> tuple[DataFrame, DataFrame]:
    """Older lookup by combination id: the channels per order, and what has no combination.

    Texts match without regard to case; null matches nothing.
    """
    combos = order_combinations.select(F.lower("OrderSource_map").alias(_CHANNEL),
                                       F.lower("OrderType_map").alias(_TYPE), "Combination_Id")
    combos = dedupe_by(combos.dropna(subset=[_CHANNEL, _TYPE]), [_CHANNEL, _TYPE])
    names = dedupe_by(channel_combinations.select("Combination_Id", "Enriched_Order_Type", "Enriched_Channel",
                                                  "Fulfilment_Mode"), ["Combination_Id"])
    table = combos.join(names, "Combination_Id", "left")
    orders = df.select("Header_Id", "OrderSource", "OrderType", F.lower("OrderSource").alias(_CHANNEL),
                       F.lower("OrderType").alias(_TYPE))
    found = dedupe_by(plain_join(orders, table, [_CHANNEL, _TYPE]).drop(_CHANNEL, _TYPE), ["Header_Id"])
    missing = dedupe_rows(found.filter(F.col("Combination_Id").isNull())
                          .select("OrderSource", "OrderType", "Combination_Id"))
    return found.select("Header_Id", "Enriched_Order_Type", "Enriched_Channel", "Fulfilment_Mode",
                        "Combination_Id"), missing


def join_stores(df: DataFrame, stores: DataFrame, key: str = "updated_code") -> DataFrame:
    """Adds the store dimension by store code; ``stores`` is unique on ``key``."""
    return plain_join(df.withColumn("_store_key", F.col("StoreCode")),
                      stores.withColumn("_store_key", F.col(key)), ["_store_key"]).drop("_store_key")
