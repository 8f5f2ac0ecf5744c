"""One query per operator, over the benchmark tables.

Each takes the session and a table folder and returns a DataFrame.  Streaming
and sink queries run to the end in a fresh folder below the shared working
folder and return what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradetide import functions as fn
from tradetide import schemas as S
from tradetide.operators import aggregates, filters, joins, reconcile, series
from tradetide.plans import reports
from tradetide.session import state_partitions_of, stateful, work_dir
from tradetide.sinks import messages as messages_out
from tradetide.sinks.results import KeyedTable, reset_all, result_table
from tradetide.sources import envelopes, fixtures, generator
from tradetide.streaming.matching import GROUPS_PER_PARTITION, backlog_state, matched_stream, stream_match
from tradetide.streaming.minute_trade import stream_minute_trade
from tradetide.streaming.reports import ReportJob, periodic_report

QUERIES = {}


def query(function=None, *, name: str | None = None):
    """Register a query under its own name, or another where an import has that."""
    if function is None:
        return lambda named: query(named, name=name)
    QUERIES[name or function.__name__] = function
    return function


# ---------------------------------------------------------------- inputs


def _payments(spark, sf):
    return fixtures.payments(spark, sf)


def _orders(spark, sf):
    return joins.slim_orders(fixtures.order_messages(spark, sf))


def _matched(spark, sf):
    return joins.match_payments(_payments(spark, sf), _orders(spark, sf))


def _terminal_series(spark, sf):
    return aggregates.minute_trade_by_terminal(_payments(spark, sf))


def _tagged(spark, sf):
    return joins.tagged_union(_payments(spark, sf), _orders(spark, sf))


def _with_plat(payments: DataFrame) -> DataFrame:
    """Payments with the platform their order would have, without a join."""
    plat = F.when(F.col("order_id") % 2 == 0, S.PLAT_TB).otherwise(S.PLAT_TM)
    return payments.withColumn("plat", plat)


def _wire(spark, sf) -> DataFrame:
    """All messages as envelopes, plus rows of an unknown topic and broken bodies."""
    orders = fixtures.order_messages(spark, sf)
    good = envelopes.encode(orders, F.col("topic")).unionByName(
        envelopes.encode(_payments(spark, sf), S.TOPIC_PAYMENT)
    )
    customer = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("order_id"), F.lit(0).cast("bigint").alias("create_time")
    )
    unknown = envelopes.encode(customer, "refund")
    broken = fixtures.table(spark, sf, "supplier").select(
        F.concat(F.lit("{broken "), F.col("s_suppkey")).cast("binary").alias("body"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(S.TOPIC_PAYMENT).alias("topic"),
    )
    return good.unionByName(unknown).unionByName(broken).unionByName(
        envelopes.end_markers(spark)
    )


def _published(spark, sf, path: str, payments=None, orders=None) -> str:
    """The messages as many files in hash order, so both sides arrive interleaved."""
    payments = _payments(spark, sf) if payments is None else payments
    orders = fixtures.order_messages(spark, sf) if orders is None else orders
    wire = envelopes.encode(orders, F.col("topic")).unionByName(envelopes.encode(payments, S.TOPIC_PAYMENT))
    tables = _length(spark, f"{sf}/events.parquet", f"{sf}/orders.parquet").total
    rows = fixtures.table(spark, sf, "events").count() + fixtures.table(spark, sf, "orders").count()
    files = max(FILES, _payments(spark, sf).rdd.getNumPartitions(), -(-tables // FILE_BYTES), -(-rows // FILE_ROWS))
    messages_out.publish(wire.repartition(files, F.xxhash64("body")), path)
    messages_out.publish(envelopes.end_markers(spark), path)
    return path


# Streams here come in several micro-batches at any size, and in larger ones of at most so many bytes.
FILES, BATCHES, MOST_BYTES = 15, 5, 2**30
# State partitions are fixed for good by a job's first start; one for so many bytes of messages.
STATE_PARTITIONS, PARTITION_BYTES = 8, 2**25
# Of the tables' bytes and rows, what a file of messages per topic is made from at most.  Rows that
# compress well are as many messages in few bytes.
FILE_BYTES, FILE_ROWS = 2**23, 2**17


def _length(spark, *paths: str) -> Row:
    """Bytes of all files and of the largest one, by their listing."""
    return spark.read.format("binaryFile").load(list(paths)).agg(
        F.sum("length").alias("total"), F.max("length").alias("largest")).first()


def _batch_bytes(total: int, largest: int) -> int:
    """So many bytes that a batch takes a fifth at least, which leaves no rest for a sixth, but never a fourth."""
    return max(1, min(MOST_BYTES, total // BATCHES + largest, total // (BATCHES - 1) - 1))


def _stream(spark, path: str) -> DataFrame:
    """The published messages as a stream, in a session whose state partitions, and so the
    groups too, grow with them."""
    files = _length(spark, path)
    own = stateful(spark, max(STATE_PARTITIONS, -(-files.total // PARTITION_BYTES)))
    return envelopes.stream_topics(own, path, max_bytes=_batch_bytes(files.total, files.largest))


# ------------------------------------------------------ sources and ingest


@query
def ingest_topics(spark: SparkSession, sf: str) -> DataFrame:
    work = work_dir(spark, "ingest")
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    envelopes.catch_up(source, f"{work}/copy", f"{work}/checkpoint")
    copied = spark.read.parquet(f"{work}/copy")
    parsed = F.from_json(F.col("body").cast("string"), envelopes.MESSAGE)
    return copied.select(
        "topic", parsed["order_id"].alias("order_id"), parsed["create_time"].alias("create_time")
    )


@query
def route_topic(spark: SparkSession, sf: str) -> DataFrame:
    routed = envelopes.with_route(_wire(spark, sf))
    return routed.groupBy("route", "topic").agg(F.count("*").alias("messages"))


@query
def decode_payload(spark: SparkSession, sf: str) -> DataFrame:
    wire = _wire(spark, sf)
    orders = envelopes.decode_orders(wire)
    payments = envelopes.decode_payments(wire).withColumn("topic", F.lit(S.TOPIC_PAYMENT))
    return orders.unionByName(payments, allowMissingColumns=True)


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rejected = envelopes.quarantine(_wire(spark, sf))
    return rejected.groupBy("topic", "reason").agg(F.count("*").alias("messages"))


@query
def drop_end_markers(spark: SparkSession, sf: str) -> DataFrame:
    return envelopes.topic_progress(_wire(spark, sf))


@query
def slim_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf)


@query
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf)


@query
def decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    return envelopes.decode_messages(_wire(spark, sf))


@query
def catch_up(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds from one checkpoint; the second must bring only what is new."""
    work = work_dir(spark, "catch-up")
    copy = (f"{work}/copy", f"{work}/checkpoint")
    orders = fixtures.order_messages(spark, sf)
    messages_out.publish(envelopes.encode(orders, F.col("topic")), f"{work}/topics")
    envelopes.catch_up(_stream(spark, f"{work}/topics"), *copy)
    payments = envelopes.encode(_payments(spark, sf), S.TOPIC_PAYMENT)
    messages_out.publish(payments, f"{work}/topics")
    envelopes.catch_up(_stream(spark, f"{work}/topics"), *copy)
    return spark.read.parquet(copy[0]).groupBy("topic").agg(F.count("*").alias("messages"))


@query
def tail_topic(spark: SparkSession, sf: str) -> DataFrame:
    work = work_dir(spark, "tail")
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    envelopes.tail_topic(
        source, S.TOPIC_TB_ORDER, f"{work}/shown", f"{work}/checkpoint", availableNow=True
    ).awaitTermination()
    shown = spark.read.schema(envelopes.SHOWN).json(f"{work}/shown")
    return envelopes.decode_orders(shown.withColumn("body", F.col("body").cast("binary")))


@query
def gen_orders(spark: SparkSession, sf: str) -> DataFrame:
    index = fixtures.table(spark, sf, "orders").select(F.col("o_orderkey").alias("i"))
    return generator.gen_orders(index)


@query
def gen_payments(spark: SparkSession, sf: str) -> DataFrame:
    return generator.gen_payments(gen_orders(spark, sf))


@query
def hello_rate(spark: SparkSession, sf: str) -> DataFrame:
    return generator.hello(fixtures.table(spark, sf, "events").select("event_id"))


# ------------------------------------- projections, filters, scalar functions


@query
def minute_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return _payments(spark, sf).select(
        "order_id", "pay_source", fn.minute_bucket("create_time").alias("minute")
    )


@query
def filter_type(spark: SparkSession, sf: str) -> DataFrame:
    pay = filters.of_type(_tagged(spark, sf), "pay")
    return pay.select("order_id", "pay_amount", "pay_source", "pay_platform", "create_time")


@query
def decode_trade_platform(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.order_messages(spark, sf).select(
        "order_id", fn.trade_platform("topic").alias("plat")
    )


@query
def decode_pay_platform(spark: SparkSession, sf: str) -> DataFrame:
    return filters.valid_terminals(_payments(spark, sf)).select(
        "order_id", "pay_source", "terminal"
    )


@query
def invalid_pay_platform(spark: SparkSession, sf: str) -> DataFrame:
    return filters.invalid_terminals(_payments(spark, sf))


@query
def decode_pay_source(spark: SparkSession, sf: str) -> DataFrame:
    return _payments(spark, sf).select(
        "order_id", "pay_source", fn.pay_source_name("pay_source").alias("source_name")
    )


@query
def round_cents(spark: SparkSession, sf: str) -> DataFrame:
    """Half a discounted line price: many exact half cents, both signs."""
    half = (F.col("l_extendedprice") * F.col("l_discount") - 500.0) / 2
    return fixtures.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.round_cents(half).alias("rounded")
    )


@query
def round_half_even(spark: SparkSession, sf: str) -> DataFrame:
    half = (F.col("l_extendedprice") * F.col("l_discount") - 500.0) / 2
    return fixtures.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.round_half_even(half).alias("rounded")
    )


@query
def result_key(spark: SparkSession, sf: str) -> DataFrame:
    return _terminal_series(spark, sf).select(
        "pay_platform", fn.result_key(S.PREFIX_RATIO, "minute").alias("key")
    )


@query
def positive_amounts(spark: SparkSession, sf: str) -> DataFrame:
    amounts = fixtures.table(spark, sf, "events").selectExpr(
        "event_id", "floor(value) as pay_amount"
    )
    return filters.positive_amounts(amounts)


@query
def amount_check(spark: SparkSession, sf: str) -> DataFrame:
    amounts = fixtures.table(spark, sf, "customer").selectExpr("floor(c_acctbal) as pay_amount")
    return filters.amount_check(amounts)


@query
def order_total_check(spark: SparkSession, sf: str) -> DataFrame:
    return joins.order_total_check(_payments(spark, sf), _orders(spark, sf))


@query
def parse_number(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers where there are any; every seventh text is a word."""
    text = "case when event_id % 7 = 0 then event_type else concat(user_id, '.25') end"
    return fixtures.table(spark, sf, "events").select(
        "event_id", fn.parse_number(F.expr(text)).alias("number")
    )


@query
def concat_world(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "events").select(
        "event_id", fn.concat_world("event_type").alias("message")
    )


# ------------------------------------------------------------------- joins


@query
def match_payments(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf)


@query
def settled_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.settled_orders(_payments(spark, sf), _orders(spark, sf))


@query
def pending_payments(spark: SparkSession, sf: str) -> DataFrame:
    return joins.pending_payments(_payments(spark, sf), _orders(spark, sf))


@query
def open_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.open_orders(_payments(spark, sf), _orders(spark, sf))


@query
def orders_seen(spark: SparkSession, sf: str) -> DataFrame:
    ids = _payments(spark, sf).select("order_id").distinct()
    return joins.orders_seen(ids, _orders(spark, sf))


@query
def rematch_pending(spark: SparkSession, sf: str) -> DataFrame:
    """The tb orders came in time, the tm orders repair what is pending."""
    payments, orders = _payments(spark, sf), _orders(spark, sf)
    early, late = orders.filter("plat = 'tb'"), orders.filter("plat = 'tm'")
    pending = joins.pending_payments(payments, early)
    return joins.rematched(pending, late).select("order_id", "pay_amount", "status")


@query
def ratio_join(spark: SparkSession, sf: str) -> DataFrame:
    return series.ratio_join(series.cumulative_trade(_terminal_series(spark, sf), "pay_platform"))


def _turnover_expected(spark, sf):
    expected = aggregates.expected_by_platform(_with_plat(_payments(spark, sf)))
    rows = reports.turnover_rows(expected.withColumnRenamed("expected", "trade"))
    return rows.withColumnRenamed("value", "expected")


@query(name="reconcile")
def reconcile_turnover(spark: SparkSession, sf: str) -> DataFrame:
    """Against what was published: each expected key is looked up in the result table."""
    expected = _turnover_expected(spark, sf)
    published = _turnover_table(spark, sf).lookup(expected.select("key"))
    return reconcile.reconcile(expected, published)


@query
def reconcile_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Looked up in what a job published that counted matched payments only."""
    payments = _payments(spark, sf)
    expected = reports.ratios(payments).withColumnRenamed("value", "expected")
    matched = joins.orders_seen(payments, _orders(spark, sf))
    table = result_table(spark, work_dir(spark, "ratios"))
    table.upsert(reports.ratios(matched), 0)
    return reconcile.reconcile_ratio(expected, table.lookup(expected.select("key")))


# ------------------------------------------------------------ aggregations


@query
def minute_trade_by_platform(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.minute_trade_by_platform(_matched(spark, sf))


@query
def minute_trade_by_terminal(spark: SparkSession, sf: str) -> DataFrame:
    return _terminal_series(spark, sf)


@query
def turnover_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.turnover(_payments(spark, sf), _orders(spark, sf))


@query
def running_minute_trade(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.running_minute_trade(_payments(spark, sf))


@query
def minute_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.minute_bounds(_terminal_series(spark, sf), "pay_platform")


@query
def message_counts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.message_counts(_tagged(spark, sf))


@query
def distinct_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_minutes(_payments(spark, sf))


@query
def result_keys(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.turnover_keys(_matched(spark, sf))


@query
def paid_per_order(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.paid_per_order(_payments(spark, sf))


@query
def reconcile_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.reconcile_totals(reconcile_turnover(spark, sf))


@query
def expected_results(spark: SparkSession, sf: str) -> DataFrame:
    """Orders 20 seconds apart, so that the series has many minutes."""
    index = fixtures.table(spark, sf, "orders").select(F.col("o_orderkey").alias("i"))
    payments = generator.gen_payments(generator.gen_orders(index, step_ms=20_000))
    payments = payments.withColumn("plat", fn.trade_platform("topic"))
    return aggregates.expected_results(payments)


# ------------------------------------------------------ window, time series


@query
def dense_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return series.dense_minutes(_terminal_series(spark, sf), "pay_platform")


@query
def cumulative_trade(spark: SparkSession, sf: str) -> DataFrame:
    return series.cumulative_trade(_terminal_series(spark, sf), "pay_platform")


@query
def mobile_pc_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return series.mobile_pc_ratio(_terminal_series(spark, sf))


@query
def mobile_pc_ratio_compat(spark: SparkSession, sf: str) -> DataFrame:
    return series.mobile_pc_ratio_compat(_terminal_series(spark, sf))


@query
def ladder_sum(spark: SparkSession, sf: str) -> DataFrame:
    return series.ladder_sum(_terminal_series(spark, sf), "pay_platform")


@query
def latest_key(spark: SparkSession, sf: str) -> DataFrame:
    return series.latest_key(_terminal_series(spark, sf), "pay_platform")


# -------------------------------------------------------- sort, set operations


@query
def sort_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.sort_series(aggregates.minute_trade_by_platform(_matched(spark, sf)))


@query
def key_union(spark: SparkSession, sf: str) -> DataFrame:
    minutes = _terminal_series(spark, sf)
    key = fn.result_key(S.PREFIX_RATIO, "minute").alias("key")
    pc = minutes.filter(F.col("pay_platform") == S.TERMINAL_PC).select(key)
    mobile = minutes.filter(F.col("pay_platform") == S.TERMINAL_MOBILE).select(key)
    return series.key_union(pc, mobile)


# --------------------------------------------------------------- streaming


@query(name="stream_minute_trade")
def stream_trade_by_minute(spark: SparkSession, sf: str) -> DataFrame:
    work = work_dir(spark, "minute-trade")
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    keys = "pay_platform smallint, minute bigint"
    minutes = KeyedTable(spark, f"{work}/minutes", keys).create()

    def save(changed: DataFrame, batch_id: int) -> None:
        minutes.upsert(changed.withColumnRenamed("trade", "value"), batch_id)

    changed = stream_minute_trade(envelopes.decode_payments(source))
    (
        changed.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return minutes.current().withColumnRenamed("value", "trade")


def _per_order_minute(matched: DataFrame) -> DataFrame:
    """Sums do not depend on how the micro-batches cut the stream."""
    return matched.groupBy("order_id", "plat", "minute").agg(
        F.sum("pay_amount").cast("double").alias("pay_amount")
    )


@query(name="stream_match")
def stream_matched_payments(spark: SparkSession, sf: str) -> DataFrame:
    work = work_dir(spark, "match")
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    stream_match(envelopes.decode_messages(source), work).awaitTermination()
    return _per_order_minute(spark.read.parquet(f"{work}/matched"))


@query(name="stream_match_keyed")
def stream_matched_payments_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Settled orders leave the state; to a file sink."""
    work = work_dir(spark, "match-keyed")
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    matched = matched_stream(envelopes.decode_messages(source), keep_settled=False)
    envelopes.catch_up(matched, f"{work}/matched", f"{work}/checkpoint")
    return _per_order_minute(spark.read.parquet(f"{work}/matched"))


@query
def stream_match_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """A batch job takes in what is there, the stream goes on from what that left over."""
    work = work_dir(spark, "match-backlog")
    payments, orders = _payments(spark, sf), fixtures.order_messages(spark, sf)
    # Unlike parts of both sides, so that either may come first.
    early_pay, early_order = F.pmod("create_time", F.lit(5)) < 2, F.pmod("order_id", F.lit(3)) == 0
    old_pays, old_orders = payments.filter(early_pay), joins.slim_orders(orders.filter(early_order))
    path = _published(spark, sf, f"{work}/topics", payments.filter(~early_pay), orders.filter(~early_order))
    source = _stream(spark, path)
    groups = GROUPS_PER_PARTITION * state_partitions_of(source.sparkSession)
    stream_match(
        envelopes.decode_messages(source), work, groups=groups, backlog=backlog_state(old_pays, old_orders, groups)
    ).awaitTermination()
    batch = joins.match_payments(old_pays, old_orders).groupBy("order_id", "plat", "minute").agg(
        fn.exact_sum("pay_amount").alias("pay_amount"))
    streamed = spark.read.parquet(f"{work}/matched").select(*batch.columns)
    return _per_order_minute(batch.unionByName(streamed))


def _finished_report(spark, sf, purpose: str) -> ReportJob:
    """A report job that has caught up with all messages, stray ones included."""
    work = work_dir(spark, purpose)
    source = _stream(spark, _published(spark, sf, f"{work}/topics"))
    return periodic_report(source, f"{work}/job", availableNow=True)


@query(name="periodic_report")
def report_turnover_and_ratio(spark: SparkSession, sf: str) -> DataFrame:
    turnover, ratio = _finished_report(spark, sf, "report").published()
    return turnover.unionByName(ratio)


@query
def state_report(spark: SparkSession, sf: str) -> DataFrame:
    """From the state, and from the progress events of the run."""
    job = _finished_report(spark, sf, "state")
    last = F.max_by("backlog_files", "batch_id")
    progress = job.progress.rows().agg(F.sum("input_rows").alias("input_rows"), last.alias("backlog_files"))
    metrics = F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in progress.columns]))
    return job.state_report().unionByName(progress.select(metrics))


@query
def reconcile_job(spark: SparkSession, sf: str) -> DataFrame:
    """Both series as a job published them, at one and the same batch, against what is expected."""
    turnover, ratio = _finished_report(spark, sf, "reconcile").published()
    expected = _turnover_expected(spark, sf)
    ratios = reports.ratios(_payments(spark, sf)).withColumnRenamed("value", "expected")
    return reconcile.reconcile(expected, turnover).unionByName(reconcile.reconcile(ratios, ratio))


# ------------------------------------------------------------------- sinks


def _turnover_table(spark, sf) -> KeyedTable:
    """Turnover published in two batches, of which the second corrects the first."""
    table = result_table(spark, work_dir(spark, "results"))
    rows = reports.turnover(_payments(spark, sf), _orders(spark, sf))
    table.upsert(rows.withColumn("value", F.col("value") / 2), 0)
    table.upsert_changed(rows, 1)
    return table


@query
def upsert_results(spark: SparkSession, sf: str) -> DataFrame:
    return _turnover_table(spark, sf).current()


@query
def lookup_results(spark: SparkSession, sf: str) -> DataFrame:
    """All expected keys, also those that were never published."""
    return _turnover_table(spark, sf).lookup(_turnover_expected(spark, sf).select("key"))


@query
def delete_results(spark: SparkSession, sf: str) -> DataFrame:
    table = _turnover_table(spark, sf)
    table.delete(table.current().filter("value < 20"), 2)
    return table.current()


@query
def reset_results(spark: SparkSession, sf: str) -> DataFrame:
    """Both published series: turnover and ratios."""
    turnover = _turnover_table(spark, sf)
    ratio = result_table(spark, work_dir(spark, "ratios"))
    ratio.upsert(reports.ratios(_payments(spark, sf)), 0)
    reset_all([turnover, ratio], 2)
    return turnover.current().unionByName(ratio.current())


@query
def increment_results(spark: SparkSession, sf: str) -> DataFrame:
    """Each payment adds to its minute, on top of what was published."""
    table = _turnover_table(spark, sf)
    payments = _with_plat(_payments(spark, sf))
    prefix = F.when(F.col("plat") == S.PLAT_TB, S.PREFIX_TB).otherwise(S.PREFIX_TM)
    deltas = payments.select(
        fn.result_key(prefix, fn.minute_bucket("create_time")).alias("key"),
        F.col("pay_amount").alias("value"),
    )
    table.increment(deltas, 2)
    return table.current()


@query
def publish_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Generated messages, published, read back and decoded."""
    path = work_dir(spark, "publish")
    orders = gen_orders(spark, sf)
    messages_out.publish_messages(orders, generator.gen_payments(orders), path)
    return envelopes.decode_messages(envelopes.read_topics(spark, path))


@query
def append_text(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "text")
    messages_out.append_text(concat_world(spark, sf).select("message"), path)
    return spark.read.text(path)
