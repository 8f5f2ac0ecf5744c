"""Carrying a row's own columns through work that adds columns of any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def packed(frame: DataFrame, text: str = "text", **added: Column) -> DataFrame:
    """``text``, the ``added`` columns, and all others of the row in one struct."""
    others = [F.col(f"`{c}`") for c in frame.columns if c != text] or [F.lit(None).alias("_")]
    return frame.select(
        F.struct(*others).alias(ROW), F.col(text).alias("text"), *[c.alias(n) for n, c in added.items()])


def unpacked(frame: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that were packed, in their order, with the text as it is now."""
    return frame.select(*[
        F.col("text").alias(text) if c == text else F.col(ROW).getField(c).alias(c) for c in columns])
