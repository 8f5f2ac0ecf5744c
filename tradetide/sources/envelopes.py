"""Messages from several topics: reading, routing and decoding.

A message is an envelope (topic, body, ts).  Bodies are JSON; a body of two
zero bytes marks the end of its topic.  Nothing is thrown away silently: what
is neither a marker nor a valid record of a known topic is quarantined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide import schemas as S
from tradetide.functions import trade_platform

# Every field that matching and both reports need; parsing reads no others.
MESSAGE = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("create_time", T.LongType()),
    T.StructField("pay_amount", T.DoubleType()),
    T.StructField("pay_source", T.ShortType()),
    T.StructField("pay_platform", T.ShortType()),
    T.StructField("total_price", T.DoubleType()),
])


def read_topics(spark: SparkSession, path: str, topics: Sequence[str] = S.TOPICS) -> DataFrame:
    """Envelope files of the given topics; files of other topics are not opened."""
    rows = spark.read.schema(S.ENVELOPE).parquet(path)
    return rows.filter(F.col("topic").isin(*topics))


def stream_topics(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] = S.TOPICS,
    max_bytes: int | None = None,
) -> DataFrame:
    """The same files as a stream; ``max_bytes`` bounds one micro-batch, but for one file."""
    reader = spark.readStream.schema(S.ENVELOPE)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path).filter(F.col("topic").isin(*topics))


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = S.TOPICS,
    max_offsets: int | None = None,
) -> DataFrame:
    """Envelopes from Kafka.  Needs the connector on the classpath; not tested here."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").alias("body"), F.col("timestamp").alias("ts"), "topic"
    )


def encode(records: DataFrame, topic: str | Column) -> DataFrame:
    """Records to envelopes; the topic is not part of the body."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    fields = [name for name in records.columns if name != "topic"]
    return records.select(
        F.to_json(F.struct(*fields)).cast("binary").alias("body"),
        F.timestamp_millis("create_time").alias("ts"),
        topic.alias("topic"),
    )


def end_markers(spark: SparkSession, topics: Sequence[str] = S.TOPICS) -> DataFrame:
    """One end-of-stream envelope per topic."""
    return spark.range(1).select(
        F.lit(S.END_MARKER).alias("body"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.explode(F.array(*[F.lit(topic) for topic in topics])).alias("topic"),
    )


def _is_marker() -> Column:
    return F.coalesce(F.col("body") == F.lit(S.END_MARKER), F.lit(False))


def drop_end_markers(envelopes: DataFrame) -> DataFrame:
    return envelopes.filter(~_is_marker())


def topic_progress(envelopes: DataFrame) -> DataFrame:
    """Messages per topic, and whether its end marker has been seen."""
    return envelopes.groupBy("topic").agg(
        F.count_if(~_is_marker()).alias("messages"), F.bool_or(_is_marker()).alias("ended")
    )


def with_route(envelopes: DataFrame) -> DataFrame:
    """Add where a message belongs: ``pay``, ``order`` or ``unknown``."""
    topic = F.col("topic")
    route = (
        F.when(topic == S.TOPIC_PAYMENT, "pay")
        .when(topic.isin(S.TOPIC_TB_ORDER, S.TOPIC_TM_ORDER), "order")
        .otherwise("unknown")
    )
    return envelopes.withColumn("route", route)


def _parsed(envelopes: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the parsed body as ``record``, null where it does not parse.

    As a plain column the parser would be copied into every filter and field
    access on the record.  As the output of a generator it runs once per body.
    """
    record = F.from_json(F.col("body").cast("string"), schema)
    return envelopes.select("*", F.explode(F.array(record)).alias("record"))


# What a record may hold: amounts that sums hold exactly, and times from 1970 to 2100.
# A single time beyond would stretch a minute series over everything in between.
MAX_AMOUNT = 1e12
MAX_TIME = 4_102_444_800_000


def _in_range(amount: str) -> Column:
    return F.abs(f"record.{amount}") <= MAX_AMOUNT


def _in_time() -> Column:
    time = F.col("record.create_time")
    return (time >= 0) & (time < MAX_TIME)


def _has(*fields: str) -> Column:
    usable = F.col("record").isNotNull()
    for name in fields:
        usable = usable & F.col(f"record.{name}").isNotNull()
    return usable


def _usable_payment() -> Column:
    return _has("order_id", "create_time", "pay_amount") & _in_range("pay_amount") & _in_time()


def _usable_order() -> Column:
    """An order's time is not used, so it may lack one, but not have an impossible one."""
    timed = F.coalesce(_in_time(), F.lit(True))
    return _has("order_id", "total_price") & _in_range("total_price") & timed


def decode_payments(envelopes: DataFrame) -> DataFrame:
    """Valid records of the payment topic."""
    mine = drop_end_markers(envelopes).filter(F.col("topic") == S.TOPIC_PAYMENT)
    return _parsed(mine, S.PAYMENT).filter(_usable_payment()).select("record.*")


def decode_orders(envelopes: DataFrame) -> DataFrame:
    """Valid records of both order topics, with their topic."""
    mine = drop_end_markers(envelopes).filter(
        F.col("topic").isin(S.TOPIC_TB_ORDER, S.TOPIC_TM_ORDER)
    )
    return _parsed(mine, S.ORDER).filter(_usable_order()).select("record.*", "topic")


def _message_valid() -> Column:
    pay = (F.col("route") == "pay") & _usable_payment()
    order = (F.col("route") == "order") & _usable_order()
    return pay | order


def decode_messages(envelopes: DataFrame) -> DataFrame:
    """All valid messages as one tagged union, in a single pass over the source."""
    parsed = _parsed(with_route(drop_end_markers(envelopes)), MESSAGE)
    return parsed.filter(_message_valid()).select(
        F.col("route").alias("type"),
        "record.*",
        F.when(F.col("route") == "order", trade_platform("topic")).alias("plat"),
    )


def _rejection(terminals: bool) -> tuple[Column, Column]:
    """Is a parsed message rejected, or with ``terminals`` of an unknown terminal, and why?"""
    amount = F.when(F.col("route") == "pay", F.col("record.pay_amount")).otherwise(F.col("record.total_price"))
    whole = F.col("record.order_id").isNotNull() & amount.isNotNull()
    reason = (
        F.when(F.col("route") == "unknown", "topic")
        .when(whole & ~(F.abs(amount) <= MAX_AMOUNT), "amount")
        .when(whole & ~_in_time(), "time")
        .otherwise("body")
    )
    rejected = ~F.coalesce(_message_valid(), F.lit(False))
    if terminals:
        known = F.col("record.pay_platform").isin(S.TERMINAL_PC, S.TERMINAL_MOBILE)
        stray = (F.col("route") == "pay") & ~F.coalesce(known, F.lit(False))
        reason = F.when(rejected, reason).otherwise("terminal")
        rejected = rejected | stray
    return rejected, reason


def quarantine(envelopes: DataFrame, terminals: bool = False) -> DataFrame:
    """Rejected messages with the reason: an unknown ``topic``, a ``body`` that does not
    decode, an ``amount`` or a ``time`` out of range.

    With ``terminals`` also payments of an unknown ``terminal``, which count for turnover
    but for no terminal's series.
    """
    parsed = _parsed(with_route(drop_end_markers(envelopes)), MESSAGE)
    rejected, reason = _rejection(terminals)
    return parsed.filter(rejected).select("topic", "body", reason.alias("reason"))


def classify(envelopes: DataFrame) -> DataFrame:
    """``decode_messages`` and ``quarantine`` (with terminals) in one parse of each body.

    ``type`` is ``pay``, ``order`` or ``rejected``; rejects have their topic, body and
    reason.  A payment of an unknown terminal comes as both.
    """
    parsed = _parsed(with_route(drop_end_markers(envelopes)), MESSAGE)
    rejected, reason = _rejection(terminals=True)
    # One pass of its own, for the same reason as the parser's; few messages need the reason.
    judged = parsed.select("*", F.explode(F.array(F.struct(
        F.coalesce(_message_valid(), F.lit(False)).alias("valid"), rejected.alias("rejected"),
        F.when(rejected, reason).alias("reason")))).alias("j"))
    # Spelled out: a filter over an array would leave the generated code, for every message.
    types = (
        F.when(F.col("j.valid") & F.col("j.rejected"), F.array("route", F.lit("rejected")))
        .when(F.col("j.valid"), F.array("route"))
        .otherwise(F.array(F.lit("rejected"))))
    each = judged.select("*", F.explode(types).alias("type"))
    fails = F.col("type") == "rejected"

    def if_good(name: str) -> Column:
        return F.when(~fails, F.col(f"record.{name}")).alias(name)

    return each.select(
        "type", *[if_good(f.name) for f in MESSAGE],
        F.when(F.col("type") == "order", trade_platform("topic")).alias("plat"),
        *[F.when(fails, F.col(c)).alias(c) for c in ("topic", "body")], F.when(fails, F.col("j.reason")).alias("reason"))


def catch_up(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Copy everything that is new since the last call to ``path``, then stop.

    The checkpoint holds the position, so a later call continues after it.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


SHOWN = "topic string, body string, ts timestamp"


def tail_topic(stream: DataFrame, topic: str, path: str, checkpoint: str, **trigger):
    """Write out every message of one topic in full, one JSON line each, as they come.

    Returns the running query.
    """
    return (
        stream.filter(F.col("topic") == topic)
        .select("topic", F.col("body").cast("string").alias("body"), "ts")
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )
