"""One-minute tumbling sums over the payment stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.functions import exact_sum
from tradetide.operators.aggregates import minute_trade_by_terminal
from tradetide.operators.filters import valid_terminals
from tradetide.session import checked_state_session


def stream_minute_trade(payments: DataFrame, watermark: str | None = None) -> DataFrame:
    """Turnover per terminal and minute, to be written in ``update`` mode.

    Without a watermark late payments are always counted and state stays at one
    row per terminal and minute.  With one, minutes older than the watermark
    are dropped from state and payments later than that are lost.

    The stream is read in a session of ``session.stateful``, which fixes the state partitions.
    """
    if payments.isStreaming:
        checked_state_session(payments)
    if watermark is None:
        return minute_trade_by_terminal(payments)
    timed = valid_terminals(payments).withColumn("ts", F.timestamp_millis("create_time"))
    return (
        timed.withWatermark("ts", watermark)
        .groupBy("pay_platform", F.window("ts", "1 minute"))
        .agg(exact_sum("pay_amount").cast("double").alias("trade"))
        .select("pay_platform", F.unix_seconds("window.start").alias("minute"), "trade")
    )
