"""Small helpers for columns that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add: its own result wins over an
    input column of the same name (in any case of letters, as Spark resolves names)."""
    mine = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in mine])


def whole_text(name: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def pack_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct, so that columns added beside it cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
