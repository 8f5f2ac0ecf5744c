"""The running jobs: streams in, published results out.

A job keeps tables of minute totals and, after each micro-batch, publishes the
keys whose value changed.  A trigger interval sets how often it reports.
"""

from __future__ import annotations

import threading
import time
from functools import reduce

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tradetide import schemas as S
from tradetide.functions.money import money_of
from tradetide.operators.series import mobile_pc_ratio
from tradetide.plans.reports import ratio_rows, turnover_rows
from tradetide.session import checked_state_session
from tradetide.sinks.results import KeyedTable, result_table
from tradetide.sources.envelopes import classify
from tradetide.streaming.matching import held, minute_stream
from tradetide.streaming.minute_trade import stream_minute_trade

# How often each series and the state report are published.
TURNOVER_INTERVAL = "25 seconds"
RATIO_INTERVAL = "30 seconds"
STATE_INTERVAL_SECONDS = 20


def _per_minute(rows: DataFrame) -> DataFrame:
    """What rows add to the minutes of their series."""
    return rows.groupBy("series", "minute").agg(
        money_of(F.sum("whole"), F.sum("millionths")).cast("double").alias("value"))


def _ratios(minutes: DataFrame, prefix: str) -> DataFrame:
    """A late payment changes the ratio of every later minute, so ratios are recomputed from
    the minute totals: one row per terminal and minute, however many payments there are."""
    series = minutes.select(F.col("series").try_cast("smallint").alias("pay_platform"), "minute", F.col("value").alias("trade"))
    return ratio_rows(mobile_pc_ratio(series), prefix)


class ReportJob:
    """Envelopes to both series, quarantine and state, by one query.

    Each message is read and parsed once.  The stateful operator gives what a
    micro-batch matched, what it adds to each terminal's minutes and what is
    rejected; these few rows are held while the tables take them in.
    """

    def __init__(self, spark: SparkSession, path: str, prefix: str = S.PREFIX_RATIO, **prefixes: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.checkpoint = f"{self.path}/checkpoint"
        self.prefix, self.prefixes = prefix, prefixes
        # Series are the trading platforms and the terminals.
        self.minutes = KeyedTable(spark, f"{self.path}/minutes", "series string, minute bigint").create()
        self.turnover = result_table(spark, f"{self.path}/turnover")
        self.ratio = result_table(spark, f"{self.path}/ratio")
        self.progress = None
        self.publish_each = True

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again gives the same tables."""
        batch = batch.persist()
        try:
            self.minutes.increment(_per_minute(batch.filter("kind <> 'rejected'")), batch_id)
            rejected = batch.filter("kind = 'rejected'").select("topic", "body", "reason")
            rejected.write.mode("overwrite").parquet(f"{self.path}/quarantine/batch_id={batch_id}")
        finally:
            batch.unpersist()
        if self.publish_each:
            self.publish(batch_id)

    def publish(self, batch_id: int) -> None:
        """Publish both series as of a batch: the keys whose value changed."""
        minutes = self.minutes.current(upto=batch_id)
        is_platform = F.col("series").isin(S.PLAT_TB, S.PLAT_TM)
        platforms = minutes.filter(is_platform).select(
            F.col("series").alias("plat"), "minute", F.col("value").alias("trade"))
        self.turnover.upsert_changed(turnover_rows(platforms, **self.prefixes), batch_id)
        self.ratio.upsert_changed(_ratios(minutes.filter(~is_platform), self.prefix), batch_id)
        done = self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
        done.write.mode("overwrite").parquet(f"{self.path}/published/batch_id={batch_id}")

    def start(
        self, stream: DataFrame, groups: int | None = None, keep_settled: bool = True,
        backlog: GroupedData | None = None, every: float = STATE_INTERVAL_SECONDS, publish_each: bool = True,
        **trigger
    ) -> StreamingQuery:
        """Run on a stream of envelopes, or of messages already decoded; every 25 seconds
        unless told otherwise, which is also often enough for the ratios.

        The state report is written every ``every`` seconds.  Without ``publish_each``
        micro-batches only add to the minutes, and ``publish`` is up to the caller.  See
        ``tagged_stream`` for the other parameters.
        """
        self.publish_each = publish_each
        messages = classify(stream) if "body" in stream.columns and "type" not in stream.columns else stream
        rows = minute_stream(messages, groups=groups, keep_settled=keep_settled, backlog=backlog)
        query = (
            rows.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**(trigger or {"processingTime": TURNOVER_INTERVAL}))
            .start()
        )
        self.progress = ProgressReport(self.spark, f"{self.path}/progress", query, every).attach()
        return query

    def published(self, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Both result tables as they were right after one and the same batch."""
        if upto is None:
            upto = self.last_batch()
        return self.turnover.current(upto), self.ratio.current(upto)

    def last_batch(self) -> int:
        """The newest batch both series were published at."""
        return self.spark.read.parquet(f"{self.path}/published").agg(F.max("batch")).first()[0]

    def state_report(self) -> DataFrame:
        """Orders and payments seen so far, and what is open among them: (metric, value).

        Read from the state when asked for; micro-batches count nothing.
        """
        orders, late, seen = held(self.spark, self.checkpoint)
        unsettled = F.abs(F.col("total_price") - F.col("paid")) > S.SETTLED_TOLERANCE
        counts = [
            seen.agg(
                F.coalesce(F.sum("orders"), F.lit(0)).alias("orders_seen"),
                F.coalesce(F.sum("payments"), F.lit(0)).alias("payments_seen")),
            orders.agg(F.count_if(unsettled).alias("open_orders"), F.count("*").alias("orders_held")),
            late.agg(
                F.countDistinct("order_id").alias("pending_orders"),
                F.coalesce(F.sum("payments"), F.lit(0)).alias("pending_payments"),
                F.count("*").alias("pending_minutes_held")),
        ]
        return reduce(DataFrame.unionByName, map(_as_metrics, counts))


class RatioJob:
    """Payments to the cumulative mobile-to-PC ratio per minute, where turnover isn't wanted."""

    def __init__(self, spark: SparkSession, path: str, prefix: str = S.PREFIX_RATIO):
        self.path = path.rstrip("/")
        self.prefix = prefix
        self.minutes = KeyedTable(spark, f"{self.path}/terminal_minutes", "series string, minute bigint").create()
        self.results = result_table(spark, f"{self.path}/ratio")

    def process(self, changed: DataFrame, batch_id: int) -> None:
        """One micro-batch of changed minute totals."""
        self.minutes.upsert(changed.select(
            F.col("pay_platform").cast("string").alias("series"), "minute", F.col("trade").alias("value")), batch_id)
        self.results.upsert_changed(_ratios(self.minutes.current(upto=batch_id), self.prefix), batch_id)

    def start(self, payments: DataFrame, **trigger) -> StreamingQuery:
        """Run on a payment stream; every 30 seconds unless told otherwise."""
        checked_state_session(payments)
        return (
            stream_minute_trade(payments)
            .writeStream.outputMode("update")
            .foreachBatch(self.process)
            .option("checkpointLocation", f"{self.path}/ratio_checkpoint")
            .trigger(**(trigger or {"processingTime": RATIO_INTERVAL}))
            .start()
        )


def periodic_report(stream: DataFrame, path: str, **options) -> ReportJob:
    """The report job on one stream, started.

    With ``availableNow=True`` it catches up, publishes what that comes to and stops.
    """
    job = ReportJob(stream.sparkSession, path)
    catching_up = bool(options.get("availableNow"))
    query = job.start(stream, publish_each=not catching_up, **options)
    if catching_up:
        query.awaitTermination()
        job.progress.detach()
        if query.lastProgress is not None:
            job.publish(query.lastProgress.batchId)
    return job


# ------------------------------------------------------------------ progress


def backlog(progress) -> dict[str, int]:
    """What is still queued at a query's sources, by the sources' own metrics."""
    found: dict[str, int] = {}
    for source in progress.sources if progress else []:
        for name, value in (source.metrics or {}).items():
            if name.endswith("Outstanding") or "OffsetsBehind" in name:
                found[name] = found.get(name, 0) + int(float(value))
    return found


def state_rows(progress) -> int:
    """Rows a query holds in its state stores, as of a progress event."""
    return sum(op.numRowsTotal for op in progress.stateOperators) if progress else 0


class ProgressReport(StreamingQueryListener):
    """Backlog, state rows and input rows of a query, written every ``every`` seconds.

    All of it comes from the query's progress events; the state isn't read.  Input
    counts from one row to the next; the last batches are written when the query ends.
    """

    COUNTS = [
        "batch_id", "batches", "input_rows", "state_rows", "backlog_files", "backlog_bytes", "backlog_offsets"]

    def __init__(self, spark: SparkSession, path: str, query: StreamingQuery, every: float):
        self.spark, self.path, self.query, self.every = spark, path, query, every
        self.written, self.batches, self.input, self.latest = 0.0, 0, 0, None
        self.lock = threading.Lock()

    def attach(self) -> ProgressReport:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        """Write what is left and listen no more."""
        self.spark.streams.removeListener(self)
        for progress in self.query.recentProgress:
            self.take(progress)
        self.write()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == str(self.query.runId):
            self.take(event.progress)
            if time.monotonic() - self.written >= self.every:
                self.write()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == str(self.query.runId):
            self.write()

    def take(self, progress) -> None:
        """Count one progress event, unless it was counted before."""
        with self.lock:
            if self.latest is not None and progress.batchId <= self.latest.batchId:
                return
            self.latest = progress
            self.batches += 1
            self.input += progress.numInputRows

    def write(self) -> None:
        with self.lock:
            if not self.batches:
                return
            queued = backlog(self.latest)
            row = (
                self.latest.batchId, self.batches, self.input, state_rows(self.latest),
                queued.get("numFilesOutstanding", 0), queued.get("numBytesOutstanding", 0),
                sum(n for name, n in queued.items() if "OffsetsBehind" in name))
            self.written, self.batches, self.input = time.monotonic(), 0, 0
        counts = self.spark.createDataFrame([row], ", ".join(f"{name} bigint" for name in self.COUNTS))
        counts.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def _as_metrics(row: DataFrame) -> DataFrame:
    """One row of counts as (metric, value) rows."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in row.columns
    ]
    return row.select(F.inline(F.array(*pairs)))
