"""Gapless numbers within groups without one task per group.

Rows of a group are dealt into buckets by the leading part of their order, rows
of a bucket are numbered by a window, and a table of bucket totals, one row per
group and bucket, gives where each bucket starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradetide.llm.components import stored


def numbered(rows: DataFrame, group: list[str], bucket: Column, order: list, count: str, start: str,
             purpose: str) -> DataFrame:
    """``rows`` with ``start``: how many units of the group come before the row.

    ``count`` names the column with the units a row stands for.  ``bucket`` must
    not fall as ``order`` rises.  ``rows`` are written once, so that the totals
    and the numbers come from the same rows.
    """
    rows = stored(rows.withColumn("_bucket", bucket), purpose)
    keys = [*group, "_bucket"]
    totals = rows.groupBy(*keys).agg(F.sum(count).alias("_in_bucket"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        totals.withColumn("_before", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0))).drop("_in_bucket"),
        f"{purpose}-starts")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}"))
    return counted.alias("c").join(starts.alias("s"), same).select(
        *[F.col(f"c.{c}").alias(c) for c in counted.columns if not c.startswith("_")],
        (F.col("_before") + F.col("_inside")).alias(start))


def expanded(rows: DataFrame, count: str, start: str, number: str, chunk: int = 4096) -> DataFrame:
    """One row for each unit of ``count``, with ``number`` from ``start`` on.

    Rows are first cut into pieces of ``chunk`` units and dealt out anew, so that
    a row that stands for very many does not expand in one task.
    """
    pieces = rows.withColumn("_piece", F.explode(F.sequence(
        F.lit(0).cast("long"), (F.col(count) - 1).cast("long"), F.lit(chunk).cast("long"))))
    heavy = pieces.where(F.col(count) > chunk).repartition(F.col(start), F.col("_piece"))
    light = pieces.where(F.col(count) <= chunk)
    every = light.unionByName(heavy)
    inside = F.sequence(F.col("_piece"), F.least(F.col(count), F.col("_piece") + chunk) - 1)
    return every.withColumn("_i", F.explode(inside)).withColumn(
        number, F.col(start) + F.col("_i")).drop("_piece", "_i", start, count)
