"""The published series: keys and values as readers look them up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.functions import result_key, round_cents
from tradetide.operators.aggregates import minute_trade_by_platform, minute_trade_by_terminal
from tradetide.operators.joins import match_payments
from tradetide.operators.series import mobile_pc_ratio


def turnover_rows(
    platform_series: DataFrame, prefix_tb: str = S.PREFIX_TB, prefix_tm: str = S.PREFIX_TM
) -> DataFrame:
    """Per-minute turnover under its key, rounded to cents only here."""
    prefix = F.when(F.col("plat") == S.PLAT_TB, prefix_tb).otherwise(prefix_tm)
    return platform_series.select(
        result_key(prefix, "minute").alias("key"), round_cents("trade").alias("value")
    )


def ratio_rows(ratios: DataFrame, prefix: str = S.PREFIX_RATIO) -> DataFrame:
    """Ratios under their key, not rounded."""
    return ratios.select(result_key(prefix, "minute").alias("key"), F.col("ratio").alias("value"))


def turnover(payments: DataFrame, slim: DataFrame, **prefixes: str) -> DataFrame:
    """Batch job: payments and orders to published turnover."""
    return turnover_rows(minute_trade_by_platform(match_payments(payments, slim)), **prefixes)


def ratios(payments: DataFrame, prefix: str = S.PREFIX_RATIO) -> DataFrame:
    """Batch job: payments to published ratios; orders are not needed."""
    return ratio_rows(mobile_pc_ratio(minute_trade_by_terminal(payments)), prefix)
