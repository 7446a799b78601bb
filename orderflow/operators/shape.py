"""Projections, renames, placeholders and null defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def column(name: str) -> Column:
    """A column by its literal name, spaces and dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def conform(df: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """One select that renames by ``renames`` and keeps ``columns`` in order.

    Names are matched without regard to case, as the output contracts spell some
    columns in two ways. Missing columns are reported together.
    """
    present = {c.lower(): c for c in df.columns}
    sources = {new.lower(): old for old, new in renames.items() if old.lower() in present}
    renamed_away = {old.lower() for old, new in renames.items()
                    if old.lower() in present and old.lower() != new.lower()}
    selected, missing = [], []
    for name in columns:
        source = sources.get(name.lower())
        if source is None and name.lower() in present and name.lower() not in renamed_away:
            source = present[name.lower()]
        if source is None:
            missing.append(name)
        else:
            selected.append(column(present[source.lower()]).alias(name))
    if missing:
        raise ValueError(f"columns not available: {', '.join(missing)}")
    return df.select(*selected)


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Renames the columns that exist."""
    return df.withColumnsRenamed(dict(renames))


def rename_old(df: DataFrame, columns: Sequence[str], prefix: str = "Old_") -> DataFrame:
    """Keeps earlier values of ``columns`` under a prefix."""
    return rename(df, {c: prefix + c for c in columns})


def add_placeholders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds empty text columns."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns})


def add_empty_columns(df: DataFrame, count: int) -> DataFrame:
    """Adds ``Empty_Column_1`` to ``Empty_Column_<count>``."""
    return add_placeholders(df, [f"Empty_Column_{i}" for i in range(1, count + 1)])


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, column(source))


def untyped_to_text(df: DataFrame) -> DataFrame:
    """Casts columns without a type to text, so that they can be written."""
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    return df.withColumns({c: column(c).cast("string") for c in untyped}) if untyped else df


def expand_struct(df: DataFrame, name: str) -> DataFrame:
    """Replaces a struct column by its fields."""
    others = [column(c) for c in df.columns if c != name]
    return df.select(*others, F.col(f"{name}.*"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Column-specific values for null."""
    return df.na.fill(dict(defaults))


def fill_text(df: DataFrame, filler: str = "") -> DataFrame:
    """One value for null in every text column; other types stay as they are."""
    return df.na.fill(filler)


def first_known(df: DataFrame, pairs: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each target, the first of its source columns that is not null."""
    return df.withColumns({t: F.coalesce(*[column(c) for c in cs]) for t, cs in pairs.items()})


def split_null(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and rows without a value in ``name``."""
    return df.filter(column(name).isNotNull()), df.filter(column(name).isNull())
