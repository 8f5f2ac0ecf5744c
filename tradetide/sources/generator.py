"""Seeded orders and payments of any size.

Every value is a function of the row's index, so any partition can be computed
again after a lost executor and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradetide import schemas as S

# Fixed values of the generated data.
BUYERS = 10_000
PRODUCTS = 2_000
MAX_TOTAL_CENTS = 10_000_000
MIN_TOTAL_CENTS = 10
PAYMENT_DELAY_MS = 100

MODULUS = 2_147_483_647
MULTIPLIER = 1_327_217_885
PERIOD_SHIFT = 16_807


def indexes(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Row indexes 0 .. rows-1 as column ``i``."""
    return spark.range(0, rows, 1, partitions).withColumnRenamed("id", "i")


def draw(index: Column, below: Column | int, stream: int) -> Column:
    """An integer in [0, below) that depends on the index and the stream number.

    An index beyond the modulus starts elsewhere than its remainder does, so values
    don't repeat with the period of the modulus.
    """
    below = F.lit(below) if isinstance(below, int) else below
    shifted = index + F.call_function("div", index, F.lit(MODULUS)) * PERIOD_SHIFT
    reduced = F.pmod(shifted, F.lit(MODULUS)).cast("bigint")
    linear = F.pmod(reduced * MULTIPLIER + stream * 1_000_003, F.lit(MODULUS))
    mixed = F.pmod(linear * linear + linear, F.lit(MODULUS))
    return F.call_function("div", mixed * below.cast("bigint"), F.lit(MODULUS))


def gen_orders(
    index: DataFrame,
    start_id: int = 1_700_000_000_000,
    start_time: int = 1_704_067_200_000,
    step_ms: int = 10,
    seed: int = 0,
) -> DataFrame:
    """One order per row of ``index`` (column ``i``, unique), with its topic."""
    i = F.col("i")
    at = i + seed
    is_tb = draw(at, 2, 1) == 0
    saler = F.when(is_tb, "tb_saler").otherwise("tm_saler")
    return index.select(
        (i + start_id).alias("order_id"),
        F.concat(F.lit("buyer"), draw(at, BUYERS, 2)).alias("buyer_id"),
        F.concat(F.lit("product"), draw(at, PRODUCTS, 3)).alias("product_id"),
        F.concat(saler, draw(at, BUYERS, 4)).alias("saler_id"),
        (i * step_ms + start_time).alias("create_time"),
        ((draw(at, MAX_TOTAL_CENTS, 5) + MIN_TOTAL_CENTS) / 100.0).alias("total_price"),
        F.when(is_tb, S.TOPIC_TB_ORDER).otherwise(S.TOPIC_TM_ORDER).alias("topic"),
    )


def gen_payments(orders: DataFrame) -> DataFrame:
    """Two payments per order that add up to its total; keeps the order's topic.

    The first, on PC, is a whole number below half the total; the second, on
    mobile, is the rest.  An order below 2.00 has no whole number to draw from
    and gets no payments.
    """
    half = F.floor(F.col("total_price") / 2)
    cents = F.floor(F.col("total_price") * 100 + 0.5)
    order_id = F.col("order_id")

    def payment(i: int, amount: Column) -> Column:
        return F.struct(
            amount.alias("pay_amount"),
            F.lit(i).cast("smallint").alias("pay_source"),
            F.lit(i % 2).cast("smallint").alias("pay_platform"),
            (F.col("create_time") + draw(order_id, PAYMENT_DELAY_MS, 6 + i)).alias("create_time"),
        )

    split = orders.filter("total_price >= 2").withColumn("first", draw(order_id, half, 8))
    both = F.array(
        payment(0, F.col("first").cast("double")),
        payment(1, (cents - F.col("first") * 100) / 100.0),
    )
    return split.select("order_id", F.explode(both).alias("p"), "topic").select(
        "order_id", "p.*", "topic"
    )


def hello(ticks: DataFrame) -> DataFrame:
    """A greeting per tick; ticks may be a table or a rate stream."""
    return ticks.withColumn("message", F.lit("Hello"))


def hello_rate(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream that greets at a fixed rate."""
    return hello(spark.readStream.format("rate").option("rowsPerSecond", per_second).load())
