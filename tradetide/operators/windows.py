"""Running sums whose groups may be too large for one task.

A window puts each of its partitions into one task.  A running total over a
whole group would put a hot minute, or a series of any length, into one, so the
group is cut into tiers that follow the sort order: totals per tier are summed
first, and rows only ever run within their tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradetide.functions import exact_sum, to_money
from tradetide.functions.money import TOTAL


def require(rows: DataFrame, *keys: str) -> DataFrame:
    """Drop rows with a null key.

    A frame that is later joined with an aggregate of itself should start with
    this: otherwise the optimizer infers the same filters for one side of the
    join only, the two sides differ, and the input is read twice instead of
    sharing one exchange.
    """
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows


def running_sum(
    rows: DataFrame,
    value: str,
    group: list[str],
    tiers: list[str],
    order: list[str],
    total: str,
) -> DataFrame:
    """Add ``total``: the sum of ``value`` over the group, up to each row.

    Rows are ordered by ``tiers + order`` within ``group``.  Each tier must not
    decrease along that order; a tier holds the rows that share its value and
    those of the tiers before it.
    """
    rows = require(rows, *group, *tiers)
    within = (
        Window.partitionBy(*group, *tiers)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = rows.withColumn(total, F.sum(to_money(value)).over(within))
    totals = rows.groupBy(*group, *tiers).agg(exact_sum(value).alias("_tier"))
    before = _sum_before(totals, group, tiers)
    return (
        inner.join(before, [*group, *tiers])
        .withColumn(total, (F.col(total) + F.col("_before")).cast(TOTAL))
        .drop("_before")
    )


def _sum_before(totals: DataFrame, group: list[str], tiers: list[str]) -> DataFrame:
    """For every tier, the sum of all tiers before it in its group."""
    *outer, last = tiers
    preceding = (
        Window.partitionBy(*group, *outer)
        .orderBy(last)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = F.coalesce(F.sum("_tier").over(preceding), F.lit(0)).cast(TOTAL)
    inner = totals.withColumn("_before", here)
    if not outer:
        return inner.drop("_tier")
    coarser = totals.groupBy(*group, *outer).agg(F.sum("_tier").cast(TOTAL).alias("_tier"))
    offsets = _sum_before(coarser, group, outer).withColumnRenamed("_before", "_offset")
    return (
        inner.join(offsets, [*group, *outer])
        .withColumn("_before", (F.col("_before") + F.col("_offset")).cast(TOTAL))
        .drop("_tier", "_offset")
    )
