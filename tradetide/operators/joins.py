"""Matching payments with orders.

Payments are the large side and one order may own a third of them.  Two rules
keep that from ending in one task:

* what only needs per-order totals (``order_balances`` and its views) is an
  aggregation of the tagged union, so a hot order shrinks to one row per map
  task before anything is shuffled, and no join is needed;
* what needs every payment (``match_payments``, ``pending_payments``) is a join
  that adaptive execution can split.  It only splits a side that is exchanged
  directly below the join.  Deduplicated orders already come out of their
  aggregation partitioned by order id, so joining on that alone would reuse the
  aggregation's exchange and rule the split out.  The join therefore carries a
  second key derived from the first, which calls for an exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.functions import exact_sum, minute_bucket, trade_platform

JOIN_KEYS = ["order_id", "order_group"]


def with_order_group(rows: DataFrame) -> DataFrame:
    """Add the second join key."""
    return rows.withColumn("order_group", F.pmod("order_id", F.lit(1024)))


def slim_orders(order_messages: DataFrame, keep_time: bool = False) -> DataFrame:
    """Keep what matching needs: id, platform and total."""
    time = ["create_time"] if keep_time else []
    return order_messages.select(
        "order_id", trade_platform("topic").alias("plat"), "total_price", *time
    )


def tagged_union(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Orders and payments as one stream of rows; rows without an id are dropped."""
    orders = slim.withColumn("type", F.lit("order"))
    tagged = payments.withColumn("type", F.lit("pay")).unionByName(
        orders, allowMissingColumns=True
    )
    return tagged.dropna(subset=["order_id"])


def platform_totals():
    """Aggregates that pick one total per order, numeric so they hash-aggregate.

    Copies of an order are alike.  Should two orders share an id, the smallest
    (platform, total) wins, whatever order the rows come in.
    """
    is_tb = F.col("plat") == S.PLAT_TB
    return [
        F.min(F.when(is_tb, F.col("total_price"))).alias("tb_total"),
        F.min(F.when(~is_tb, F.col("total_price"))).alias("tm_total"),
    ]


def chosen_order():
    """Platform and total out of ``platform_totals``."""
    plat = F.when(F.col("tb_total").isNotNull(), S.PLAT_TB).otherwise(S.PLAT_TM)
    return [plat.alias("plat"), F.coalesce("tb_total", "tm_total").alias("total_price")]


def unique_orders(slim: DataFrame) -> DataFrame:
    """One row per order id, however often the order was delivered."""
    return (
        slim.dropna(subset=["order_id", "total_price"])
        .groupBy("order_id")
        .agg(*platform_totals())
        .select("order_id", *chosen_order())
    )


def match_payments(
    payments: DataFrame, slim: DataFrame, colocated: bool = False
) -> DataFrame:
    """Every payment whose order is known, with platform and payment minute.

    ``colocated`` is for tables bucketed alike by order id: neither side is then
    shuffled, at the price of not splitting an order that fills its bucket.
    """
    keys = ["order_id"] if colocated else JOIN_KEYS
    orders = with_order_group(unique_orders(slim)).select(*keys, "plat")
    return (
        with_order_group(payments.select("order_id", "pay_amount", "create_time"))
        .join(orders, keys)
        .select(
            "order_id", "plat", minute_bucket("create_time").alias("minute"), "pay_amount"
        )
    )


def pending_payments(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Payments still waiting for their order."""
    known = with_order_group(slim.select("order_id").distinct())
    return with_order_group(payments).join(known, JOIN_KEYS, "left_anti").select(*payments.columns)


def rematched(pending: DataFrame, arrived: DataFrame) -> DataFrame:
    """Late repair: a pending table with ``plat`` and ``status`` after one join with the
    orders that came since: matched, or still pending."""
    orders = with_order_group(unique_orders(arrived)).select(*JOIN_KEYS, "plat")
    return (
        with_order_group(pending)
        .join(orders, JOIN_KEYS, "left")
        .select(
            *pending.columns, "plat",
            F.when(F.col("plat").isNull(), "pending").otherwise("matched").alias("status"),
        )
    )


def rematch_pending(pending: DataFrame, arrived: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The payments now matched and those that stay pending, out of one join."""
    both = rematched(pending, arrived)
    matched = both.filter("status = 'matched'").select(
        "order_id", "plat", minute_bucket("create_time").alias("minute"), "pay_amount"
    )
    return matched, both.filter("status = 'pending'").select(*pending.columns)


def orders_seen(order_ids: DataFrame, slim: DataFrame) -> DataFrame:
    """The given rows whose order has arrived."""
    known = with_order_group(slim.select("order_id").distinct())
    return with_order_group(order_ids).join(known, JOIN_KEYS, "left_semi").select(*order_ids.columns)


def order_balances(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Per arrived order: platform, total and the amount paid so far."""
    paid = payments.select("order_id", "pay_amount")
    return (
        tagged_union(paid, slim.select("order_id", "plat", "total_price"))
        .groupBy("order_id")
        .agg(*platform_totals(), exact_sum("pay_amount").alias("paid"))
        .filter("tb_total is not null or tm_total is not null")
        .select(
            "order_id",
            *chosen_order(),
            F.coalesce(F.col("paid").cast("double"), F.lit(0.0)).alias("paid"),
        )
    )


def _is_settled():
    return F.abs(F.col("total_price") - F.col("paid")) <= S.SETTLED_TOLERANCE


def settled_orders(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Orders paid in full, within the tolerance."""
    return order_balances(payments, slim).filter(_is_settled())


def open_orders(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Orders not yet paid in full, with the amount paid so far."""
    return order_balances(payments, slim).filter(~_is_settled())


def order_total_check(payments: DataFrame, slim: DataFrame) -> DataFrame:
    """Orders whose payments do not add up to the total exactly."""
    return order_balances(payments, slim).filter("paid <> total_price")


def ratio_join(mobile: DataFrame, pc: DataFrame) -> DataFrame:
    """Two separate cumulative series at equal minutes; minutes of one only drop out.

    Where both come out of one series, ``series.ratio_join`` reads that once.
    """
    return mobile.select("minute", F.col("cum_trade").alias("mobile_trade")).join(
        pc.select("minute", F.col("cum_trade").alias("pc_trade")), "minute"
    )
