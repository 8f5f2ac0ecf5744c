"""Grouped sums, counts and key sets; all combine map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.functions import exact_sum, minute_bucket, result_key, terminal_name, to_money
from tradetide.operators.filters import valid_terminals
from tradetide.operators.windows import running_sum

COPIES = 4096  # equal payments are expanded in pieces of this many


def minute_trade_by_platform(matched: DataFrame) -> DataFrame:
    """Turnover per trading platform and minute, from matched payments."""
    return matched.groupBy("plat", "minute").agg(
        exact_sum("pay_amount").cast("double").alias("trade")
    )


def minute_trade_by_terminal(payments: DataFrame) -> DataFrame:
    """Turnover per terminal and minute, from all payments, matched or not."""
    return (
        valid_terminals(payments)
        .groupBy("pay_platform", minute_bucket("create_time").alias("minute"))
        .agg(exact_sum("pay_amount").cast("double").alias("trade"))
    )


def running_minute_trade(payments: DataFrame) -> DataFrame:
    """Each payment with its minute's running total for its terminal.

    Tiers go down to an order's payments of one source and one range of amounts at one
    instant.  Payments equal in everything are one row with a count until their totals
    are known.  So no window depends on one minute, one instant or one order.
    """
    columns = ["pay_platform", "minute", "create_time", "order_id", "pay_source", "pay_amount"]
    rows = (
        valid_terminals(payments)
        .withColumn("minute", minute_bucket("create_time"))
        .groupBy(*columns)
        .agg(F.count("*").alias("copies"))
        .withColumns({
            "order_range": F.col("order_id") - F.pmod("order_id", F.lit(4096)),
            "part": F.struct(
                "order_id", F.coalesce("pay_source", F.lit(-32768)), F.floor("pay_amount")),
            "together": F.col("pay_amount") * F.col("copies"),
        })
    )
    summed = running_sum(
        rows,
        value="together",
        group=["pay_platform", "minute"],
        tiers=["create_time", "order_range", "part"],
        order=["pay_amount"],
        total="running_trade",
    )
    # Of equal payments the first have their fellows' amounts still before them.
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint")))
    inside = F.explode(F.sequence(
        F.col("chunk"), F.least(F.col("copies"), F.col("chunk") + COPIES) - 1))
    each = summed.withColumn("chunk", chunk).withColumn("i", inside)
    ahead = to_money("pay_amount") * (F.col("copies") - 1 - F.col("i")).cast("decimal(10,0)")
    return each.select(*columns, (F.col("running_trade") - ahead).cast("double").alias("running_trade"))


def minute_bounds(series: DataFrame, *group: str) -> DataFrame:
    """First and last minute of each series."""
    return series.groupBy(*group).agg(
        F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute")
    )


def message_counts(tagged: DataFrame) -> DataFrame:
    """Messages per kind and, for orders, platform."""
    return tagged.groupBy("type", "plat").agg(F.count("*").alias("messages"))


def distinct_minutes(payments: DataFrame) -> DataFrame:
    """One row: number of distinct payment minutes."""
    return payments.agg(F.countDistinct(minute_bucket("create_time")).alias("minutes"))


def paid_per_order(payments: DataFrame) -> DataFrame:
    """Amount paid per order id, whether or not the order arrived."""
    return payments.groupBy("order_id").agg(
        exact_sum("pay_amount").cast("double").alias("paid")
    )


def turnover_keys(matched: DataFrame, prefix_tb: str = S.PREFIX_TB, prefix_tm: str = S.PREFIX_TM):
    """Set of all turnover keys ever produced."""
    prefix = F.when(F.col("plat") == S.PLAT_TB, prefix_tb).otherwise(prefix_tm)
    minutes = matched.select("plat", "minute").distinct()
    return minutes.select(result_key(prefix, "minute").alias("key"))


def expected_by_platform(payments_with_plat: DataFrame) -> DataFrame:
    """Expected turnover, from payments that still know their order's platform.

    Zero amounts belong to the expectation although they are never published.
    """
    return payments_with_plat.groupBy(
        "plat", minute_bucket("create_time").alias("minute")
    ).agg(exact_sum("pay_amount").cast("double").alias("expected"))


def expected_results(payments_with_plat: DataFrame) -> DataFrame:
    """Expected turnover per platform and per terminal, summed from one aggregation of the
    payments by both.  ``series`` is the platform's or the terminal's name."""
    both = (
        payments_with_plat.withColumn("terminal", terminal_name("pay_platform"))
        .groupBy("plat", "terminal", minute_bucket("create_time").alias("minute"))
        .agg(exact_sum("pay_amount").alias("part"))
    )
    # Each sum counts for its platform and, if the terminal is known, for that.
    named = both.select("minute", "part", F.explode(F.array("plat", "terminal")).alias("series"))
    return named.filter("series is not null").groupBy("series", "minute").agg(
        F.sum("part").cast("double").alias("expected")
    )


def expected_by_terminal(payments: DataFrame) -> DataFrame:
    """Expected turnover per terminal."""
    return minute_trade_by_terminal(payments).withColumnRenamed("trade", "expected")
