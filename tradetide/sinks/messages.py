"""Publishing generated messages, and plain text output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.operators.filters import positive_amounts
from tradetide.sources.envelopes import encode, end_markers


def publish(envelopes: DataFrame, path: str) -> None:
    """Append envelopes as files, one folder per topic."""
    envelopes.write.mode("append").partitionBy("topic").parquet(path)


def publish_kafka(envelopes: DataFrame, servers: str) -> None:
    """Send envelopes to Kafka.  Needs the connector on the classpath; not tested here."""
    (
        envelopes.select("topic", F.col("body").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def publish_messages(orders: DataFrame, payments: DataFrame, path: str) -> None:
    """Publish orders and all payments above zero, then an end marker per topic."""
    wire = positive_amounts(payments).select(*S.PAYMENT.fieldNames())
    publish(
        encode(orders.select(*S.ORDER.fieldNames(), "topic"), F.col("topic")).unionByName(
            encode(wire, S.TOPIC_PAYMENT)
        ),
        path,
    )
    publish(end_markers(orders.sparkSession), path)


def append_text(lines: DataFrame, path: str) -> None:
    """Append a single string column as lines of text."""
    lines.write.mode("append").text(path)


def stream_text(lines: DataFrame, path: str, checkpoint: str, **trigger):
    """The same for a stream; returns the running query."""
    return (
        lines.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
