"""Payment and order views over the benchmark tables.

``events`` supplies payment times and amounts, ``orders`` supplies orders that
are never paid.  The rules below deliberately produce open orders, payments
without an order and invalid terminal codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def payments_from_events(events: DataFrame) -> DataFrame:
    """One payment per event with a positive value; works on streams too."""
    return events.filter("value > 0").selectExpr(
        "event_id div 2 as order_id",
        "value as pay_amount",
        "cast(event_id % 4 as smallint) as pay_source",
        "cast(case when event_id % 97 = 96 then 9 else event_id % 2 end as smallint)"
        " as pay_platform",
        "unix_micros(cast(ts as timestamp)) div 1000 as create_time",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_from_events(table(spark, sf_dir, "events"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders derived from the payments, and all of ``orders`` as orders never paid."""
    paid = (
        payments(spark, sf_dir)
        .filter("order_id % 50 <> 7")
        .groupBy("order_id")
        .agg(
            F.min("create_time").alias("create_time"),
            F.sum(F.col("pay_amount").cast("decimal(18,2)")).alias("paid"),
        )
        .selectExpr(
            "order_id",
            "concat('buyer', order_id % 10000) as buyer_id",
            "concat('product', order_id % 2000) as product_id",
            "concat(case when order_id % 2 = 0 then 'tb_saler' else 'tm_saler' end,"
            " order_id % 10000) as saler_id",
            "create_time",
            "cast(paid + case when order_id % 10 = 0 then 5 else 0 end as double)"
            " as total_price",
            "case when order_id % 2 = 0 then 'tb_order' else 'tm_order' end as topic",
        )
    )
    unpaid = (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "1000000000 + o_orderkey as order_id",
            "concat('buyer', o_custkey) as buyer_id",
            "'product0' as product_id",
            "case when o_orderkey % 2 = 0 then 'tb_saler0' else 'tm_saler0' end as saler_id",
            "cast(1704067200000 as bigint) as create_time",
            "o_totalprice as total_price",
            "case when o_orderkey % 2 = 0 then 'tb_order' else 'tm_order' end as topic",
        )
    )
    return paid.unionByName(unpaid).select(*S.ORDER.fieldNames(), "topic")
