"""Record schemas and the fixed values of the data model."""

from pyspark.sql import types as T

ORDER = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("buyer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("saler_id", T.StringType()),
    T.StructField("create_time", T.LongType()),  # epoch milliseconds
    T.StructField("total_price", T.DoubleType()),
])

PAYMENT = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("pay_amount", T.DoubleType()),
    T.StructField("pay_source", T.ShortType()),
    T.StructField("pay_platform", T.ShortType()),
    T.StructField("create_time", T.LongType()),  # epoch milliseconds
])

# Orders say nothing about their trading platform: the topic does.
ENVELOPE = T.StructType([
    T.StructField("body", T.BinaryType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("topic", T.StringType()),
])

# Topics, end-of-stream body, platform names and codes.
TOPIC_PAYMENT = "pay"
TOPIC_TB_ORDER = "tb_order"
TOPIC_TM_ORDER = "tm_order"
TOPICS = (TOPIC_PAYMENT, TOPIC_TB_ORDER, TOPIC_TM_ORDER)
END_MARKER = bytes([0, 0])
PLAT_TB = "tb"
PLAT_TM = "tm"
TERMINAL_PC = 0
TERMINAL_MOBILE = 1
PAY_SOURCES = {0: "wallet", 1: "coupon", 2: "bank_card", 3: "other"}

# An order is settled within this distance of its total.
SETTLED_TOLERANCE = 1e-6
MINUTE = 60
DAY = 86400

# Defaults of the published keys; every function that builds keys takes them.
PREFIX_TB = "platform_tb_"
PREFIX_TM = "platform_tm_"
PREFIX_RATIO = "ratio_"
