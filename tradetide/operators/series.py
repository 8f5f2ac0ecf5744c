"""Operators on minute series: one row per (group, minute) with a ``trade``.

A series has at most one row per minute and group, but its length grows with
the calendar.  Everything that needs neighbours or running totals therefore
works per day, and a second, tiny pass over the day totals links the days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.functions import to_money
from tradetide.functions.money import TOTAL
from tradetide.operators.windows import require


def _linked(series: DataFrame, group: list[str]) -> DataFrame:
    """Add to each row: running total, following minute, first trade of the group."""
    rows = require(
        series.select(
            *group,
            "minute",
            "trade",
            to_money("trade").alias("money"),
            (F.col("minute") - F.pmod("minute", F.lit(S.DAY))).alias("day"),
        ),
        *group,
        "day",
    )
    by_day = Window.partitionBy(*group).orderBy("day")
    days = (
        rows.groupBy(*group, "day")
        .agg(
            F.sum("money").cast(TOTAL).alias("day_money"),
            F.min("minute").alias("day_start"),
            F.min_by("money", "minute").alias("day_first"),
        )
        .select(
            *group,
            "day",
            F.coalesce(
                F.sum("day_money").over(by_day.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).cast(TOTAL).alias("before"),
            F.lead("day_start").over(by_day).alias("next_day_start"),
            F.first("day_first")
            .over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            .alias("first_money"),
        )
    )
    in_day = Window.partitionBy(*group, "day").orderBy("minute")
    running = F.sum("money").over(in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("running", running)
        .withColumn("next_minute", F.lead("minute").over(in_day))
        .join(days, [*group, "day"])
        .select(
            *group,
            "minute",
            "trade",
            (F.col("before") + F.col("running")).cast(TOTAL).alias("cum_money"),
            F.coalesce("next_minute", "next_day_start").alias("next_minute"),
            "first_money",
        )
    )


def _filled(linked: DataFrame) -> DataFrame:
    """Repeat each row, as ``at``, for the empty minutes up to the next one.

    Goes by day and then by minute, so that a gap of years takes no array of
    all its minutes.
    """
    day_of = F.col("minute") - F.pmod("minute", F.lit(S.DAY))
    last = F.coalesce(F.col("next_minute") - S.MINUTE, F.col("minute"))
    start = F.greatest("minute", "gap_day")
    stop = F.least("last", F.col("gap_day") + (S.DAY - S.MINUTE))
    days = linked.withColumn("last", last).withColumn(
        "gap_day", F.explode(F.sequence(day_of, last, F.lit(S.DAY).cast("bigint")))
    )
    return days.withColumn(
        "at", F.explode(F.sequence(start, stop, F.lit(S.MINUTE).cast("bigint")))
    )


def dense_minutes(series: DataFrame, *group: str) -> DataFrame:
    """Every minute from a group's first to its last, 0.0 where nothing was traded."""
    filled = _filled(_linked(series, list(group)))
    trade = F.when(F.col("at") == F.col("minute"), F.col("trade")).otherwise(F.lit(0.0))
    return filled.select(*group, F.col("at").alias("minute"), trade.alias("trade"))


def cumulative_trade(series: DataFrame, *group: str) -> DataFrame:
    """Running total for every minute from a group's first to its last."""
    filled = _filled(_linked(series, list(group)))
    return filled.select(
        *group, F.col("at").alias("minute"), F.col("cum_money").cast("double").alias("cum_trade")
    )


def cumulative_trade_compat(series: DataFrame, *group: str) -> DataFrame:
    """Running total that counts a group's first minute twice.

    Kept for comparing with results published that way.
    """
    filled = _filled(_linked(series, list(group)))
    twice = (F.col("cum_money") + F.col("first_money")).cast("double")
    return filled.select(*group, F.col("at").alias("minute"), twice.alias("cum_trade"))


def ladder_sum(series: DataFrame, *group: str) -> DataFrame:
    """Running total at the minutes that exist, without filling gaps."""
    return _linked(series, list(group)).select(
        *group, "minute", F.col("cum_money").cast("double").alias("cum_trade")
    )


def latest_key(series: DataFrame, *group: str) -> DataFrame:
    """Last minute of each group with its running total, which is the whole sum."""
    return series.groupBy(*group).agg(
        F.max("minute").alias("minute"),
        F.sum(to_money("trade")).cast("double").alias("cum_trade"),
    )


def ratio_join(cumulative: DataFrame) -> DataFrame:
    """Both terminals' running totals at the minutes both series cover.

    Picking both terminals out of one series costs a small exchange on the
    minute; joining the series to itself would compute it twice.
    """
    at = F.col("pay_platform")
    return (
        cumulative.groupBy("minute")
        .agg(
            F.max(F.when(at == S.TERMINAL_MOBILE, F.col("cum_trade"))).alias("mobile_trade"),
            F.max(F.when(at == S.TERMINAL_PC, F.col("cum_trade"))).alias("pc_trade"),
        )
        .filter("mobile_trade is not null and pc_trade is not null")
    )


def _ratio(cumulative: DataFrame) -> DataFrame:
    """Mobile over PC; none where PC is zero."""
    return (
        ratio_join(cumulative)
        .select("minute", F.try_divide("mobile_trade", "pc_trade").alias("ratio"))
        .filter("ratio is not null")
    )


def mobile_pc_ratio(terminal_series: DataFrame) -> DataFrame:
    """Cumulative mobile turnover over cumulative PC turnover, per minute."""
    return _ratio(cumulative_trade(terminal_series, "pay_platform"))


def mobile_pc_ratio_compat(terminal_series: DataFrame) -> DataFrame:
    """The ratio with both first minutes counted twice."""
    return _ratio(cumulative_trade_compat(terminal_series, "pay_platform"))


def sort_series(series: DataFrame) -> DataFrame:
    return series.orderBy("minute")


def key_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set union of two key sets."""
    return left.select("key").union(right.select("key")).distinct()
