"""Streams must end where the batch jobs end, in whatever order rows come."""

import pytest
from helpers import payments, rows, slim
from pyspark.sql import functions as F

from tradetide.operators import aggregates, joins
from tradetide.operators.filters import of_type
from tradetide.plans import reports
from tradetide.session import stateful
from tradetide.sinks import messages
from tradetide.sources import envelopes, fixtures
from tradetide.streaming.matching import backlog_state, combine, held, matched_stream, stream_match, tagged_stream
from tradetide.streaming.minute_trade import stream_minute_trade
from tradetide.streaming.reports import RatioJob, ReportJob, backlog, periodic_report


def batch(spark, pays=(), orders=()):
    """One micro-batch of tagged messages."""
    return joins.tagged_union(payments(spark, *pays), slim(spark, *orders))


COLUMNS = ["type", "order_id", "plat", "total_price", "create_time", "pay_amount", "pay_source", "pay_platform"]


@pytest.fixture
def own(spark):
    """A session for stateful queries with few partitions."""
    return stateful(spark, 2)


def sums(frame):
    return rows(frame.groupBy("order_id", "plat", "minute").agg(F.sum("pay_amount").cast("double").alias("a")))


def feed(own, tmp_path, parts, **options):
    """Takes in the parts as one micro-batch each; what each of them matched."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in parts:
        part.select(COLUMNS).coalesce(1).write.mode("append").parquet(source)
    read = own.readStream.schema(parts[0].select(COLUMNS).schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream_match(read, out, **options).awaitTermination()
    return [sums(own.read.parquet(f"{out}/matched/batch_id={i}")) for i in range(len(parts))]


def state_of(own, tmp_path):
    """Orders with what was paid, and waiting minutes."""
    orders, late, _ = held(own, str(tmp_path / "out" / "checkpoint"))
    return rows(orders), rows(late)


def test_order_before_between_and_after_its_payments(spark, own, tmp_path):
    got = feed(own, tmp_path, [
        batch(spark, [(1, 3, 0, 0)], [(2, "tm", 9)]),
        batch(spark, [(2, 4, 0, 60_000)], [(1, "tb", 10)]),
        batch(spark, [(1, 7, 0, 0), (2, 5, 0, 0)])])
    assert got == [[], [(1, "tb", 0, 3.0), (2, "tm", 60, 4.0)], [(1, "tb", 0, 7.0), (2, "tm", 0, 5.0)]]
    assert state_of(own, tmp_path) == ([(1, "tb", 10.0, 10.0), (2, "tm", 9.0, 9.0)], [])


def test_payment_after_settlement_stays_pending_if_settled_orders_go(spark, own, tmp_path):
    parts = [batch(spark, [(1, 10, 0, 0)], [(1, "tb", 10), (2, "tm", 0)]), batch(spark, [(1, 2, 0, 0), (2, 1, 0, 0)])]
    assert feed(own, tmp_path / "keep", parts)[1] == [(1, "tb", 0, 2.0), (2, "tm", 0, 1.0)]
    assert feed(own, tmp_path / "evict", parts, keep_settled=False)[1] == []
    assert state_of(own, tmp_path / "evict") == ([], [(1, 0, 2.0, 1), (2, 0, 1.0, 1)])


def test_redelivered_order_keeps_what_was_paid(spark, own, tmp_path):
    feed(own, tmp_path, [
        batch(spark, [(1, 4, 0, 0)], [(1, "tb", 10)]), batch(spark, [], [(1, "tb", 10)]), batch(spark, [(1, 6, 0, 0)])])
    assert state_of(own, tmp_path) == ([(1, "tb", 10.0, 10.0)], [])


def test_unlike_orders_of_one_id_follow_one_rule(spark, own, tmp_path):
    """Within a batch the smaller by platform and total, as in batch; else the earlier."""
    got = feed(own, tmp_path, [
        batch(spark, [(1, 1, 0, 0)], [(1, "tm", 3), (1, "tb", 9), (1, "tb", 8)]),
        batch(spark, [(1, 2, 0, 0)], [(1, "tb", 1)])])
    assert got == [[(1, "tb", 0, 1.0)], [(1, "tb", 0, 2.0)]]
    assert state_of(own, tmp_path)[0] == [(1, "tb", 8.0, 3.0)]


def test_tolerance_of_settlement(spark, own, tmp_path):
    pays = [(1, 9.9999995, 0, 0), (2, 9.99999, 0, 0)]
    feed(own, tmp_path, [batch(spark, pays, [(1, "tb", 10), (2, "tb", 10)])], keep_settled=False)
    assert [o[0] for o in state_of(own, tmp_path)[0]] == [2]


def test_order_of_very_many_payments_settles_exactly(spark, own, tmp_path):
    """100,000 payments of a cent in several parts, and sums beyond a double's millionths."""
    cents = spark.range(100_000).selectExpr(
        "'pay' as type", "1L as order_id", "string(null) as plat", "double(null) as total_price", "id % 3 * 60000 as create_time",
        "0.01D as pay_amount", "smallint(0) as pay_source", "smallint(0) as pay_platform")
    large = [(2, 123456789012.25, 0, 0)] * 40
    parts = [cents.filter("id % 2 = 0"), batch(spark, large, [(1, "tb", 1000), (2, "tm", 123456789012.25 * 40)]),
             cents.filter("id % 2 = 1")]
    feed(own, tmp_path, parts, keep_settled=False)
    assert state_of(own, tmp_path) == ([], [])


# Over-paid and paid again after settlement; delivered twice after settlement; never paid; no order.
MIXED = [
    ([(1, 10, 0, 0)], [(1, "tb", 10)]),
    ([(1, 2, 1, 60_000)], [(2, "tm", 9)]),
    ([(2, 9, 0, 0)], []),
    ([(9, 1, 0, 0)], [(2, "tm", 9), (3, "tb", 4)]),
    ([(2, 5, 1, 120_000)], [(2, "tm", 9)]),
]


@pytest.mark.parametrize("parts, state_partitions", [(1, 3), (2, 1), (5, 3)])
def test_matching_does_not_depend_on_the_cut(spark, tmp_path, parts, state_partitions):
    own = stateful(spark, state_partitions)
    source = str(tmp_path / "in")
    all_pays = [p for pays, _ in MIXED for p in pays]
    all_orders = [o for _, orders in MIXED for o in orders]
    for i in range(parts):
        chosen = MIXED[len(MIXED) * i // parts:len(MIXED) * (i + 1) // parts]
        part = batch(spark, [p for pays, _ in chosen for p in pays], [o for _, orders in chosen for o in orders])
        part.select(COLUMNS).coalesce(1).write.mode("append").parquet(source)
        read = own.readStream.schema(part.select(COLUMNS).schema).parquet(source)
        job = ReportJob(own, str(tmp_path / "job"))
        query = job.start(read, availableNow=True, publish_each=i == parts - 1)
        query.awaitTermination()
        job.progress.detach()
        # The state store has as many partitions as the session says, whatever the cores.
        assert query.lastProgress.stateOperators[0].numShufflePartitions == state_partitions
    want = reports.turnover(payments(spark, *all_pays), slim(spark, *all_orders))
    assert rows(job.turnover.current()) == rows(want)
    # Orders 1 and 2 are over-paid and 3 was never paid, so all three are open.
    assert dict(rows(job.state_report())) == {
        "orders_seen": 3.0, "payments_seen": 5.0, "open_orders": 3.0, "orders_held": 3.0, "pending_orders": 1.0,
        "pending_payments": 1.0, "pending_minutes_held": 1.0}


def test_streams_need_a_session_for_their_state(spark, topics, tmp_path):
    with pytest.raises(ValueError, match="stateful"):
        matched_stream(envelopes.decode_messages(envelopes.stream_topics(spark, topics)))
    with pytest.raises(ValueError, match="stateful"):
        stream_minute_trade(envelopes.decode_payments(envelopes.stream_topics(spark, topics)))


def test_bad_messages_are_kept_and_stop_nothing(spark, tmp_path):
    from test_sources import ORDER, wire

    def pay(i, amount, at=1704067200000, terminal=0):
        return (f'{{"order_id": {i}, "pay_amount": {amount}, "pay_source": 0, "pay_platform": {terminal},'
                f' "create_time": {at}}}').encode()

    bad = [
        ("pay", pay(1, "1e300"), "amount"), ("pay", pay(1, "1e19"), "amount"),
        ("pay", pay(1, 5, at=9 * 10**18), "time"), ("refund", pay(1, 5), "topic"), ("pay", b"{broken", "body"),
        ("pay", pay(1, 2, terminal=7), "terminal"),
    ]
    path = str(tmp_path / "t")
    messages.publish(wire(spark, ("pay", pay(1, 3)), ("tb_order", ORDER), *[b[:2] for b in bad]), path)
    own = stateful(spark, 2)
    source = envelopes.stream_topics(own, path, topics=["pay", "tb_order", "tm_order", "refund"])
    job = periodic_report(source, str(tmp_path / "job"), availableNow=True)
    assert [r[1] for r in rows(job.turnover.current())] == [5.0]
    assert {r[0] for r in rows(job.minutes.current())} == {"0", "tb"}
    kept = spark.read.parquet(str(tmp_path / "job" / "quarantine"))
    assert sorted(r.reason for r in kept.collect()) == sorted(b[2] for b in bad)
    periodic_report(source, str(tmp_path / "job"), availableNow=True)
    assert spark.read.parquet(str(tmp_path / "job" / "quarantine")).count() == len(bad)


@pytest.fixture(scope="module")
def topics(spark, sf, tmp_path_factory):
    """All messages of the small tables in hash order, published in four parts."""
    path = str(tmp_path_factory.mktemp("topics"))
    wire = envelopes.encode(fixtures.order_messages(spark, sf), F.col("topic")).unionByName(
        envelopes.encode(fixtures.payments(spark, sf), "pay"))
    for part in range(4):
        chosen = F.pmod(F.xxhash64("body"), F.lit(4)) == part
        messages.publish(wire.filter(chosen).coalesce(1), path)
    messages.publish(envelopes.end_markers(spark), path)
    return path


def stream(spark, topics):
    """Two files a batch at most."""
    files = spark.read.format("binaryFile").load(topics).agg(F.max("length")).first()[0]
    return envelopes.stream_topics(stateful(spark, 2), topics, max_bytes=files)


@pytest.fixture(scope="module")
def batch_answer(spark, sf):
    p = fixtures.payments(spark, sf)
    o = joins.slim_orders(fixtures.order_messages(spark, sf))
    return {
        "turnover": rows(reports.turnover(p, o)),
        "ratio": rows(reports.ratios(p)),
        "platform": rows(aggregates.minute_trade_by_platform(joins.match_payments(p, o))),
        "terminal": rows(aggregates.minute_trade_by_terminal(p)),
        "open": joins.open_orders(p, o).count(),
        "pending": joins.pending_payments(p, o).count(),
    }


def test_both_reports_end_where_the_batch_ends(spark, topics, batch_answer, tmp_path):
    job = ReportJob(stateful(spark, 2), str(tmp_path))
    query = job.start(stream(spark, topics), every=0, availableNow=True)
    query.awaitTermination()
    job.progress.detach()
    turnover, ratio = job.published()
    assert rows(turnover) == batch_answer["turnover"] and rows(ratio) == batch_answer["ratio"]
    progress = query.recentProgress
    assert len(progress) >= 4 and job.last_batch() == len(progress) - 1
    # One source, scanned once: each message counts once.
    messages_in = spark.read.parquet(topics).count()
    assert sum(p.numInputRows for p in progress) == messages_in and all(len(p.sources) == 1 for p in progress)
    metrics = dict(rows(job.state_report()))
    assert metrics["open_orders"] == batch_answer["open"]
    assert metrics["pending_payments"] == batch_answer["pending"]
    written = job.progress.rows().orderBy("batch_id").collect()
    assert sum(r.input_rows for r in written) == messages_in and sum(r.batches for r in written) == len(progress)
    assert written[-1].backlog_files == 0 and written[-1].state_rows > 0
    # Both tables as of an earlier batch agree with each other.
    early, early_ratio = job.published(upto=1)
    assert 0 < early.count() <= turnover.count() and 0 < early_ratio.count() <= ratio.count()


def test_one_scan_and_one_parse(spark, topics):
    frame = envelopes.classify(envelopes.read_topics(spark, topics))
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and text.count("Relation [") == 1


def test_classified_messages_are_the_decoded_and_the_rejected(spark):
    from test_sources import ORDER, wire

    bad = b'{"order_id": 1, "pay_amount": 1.5, "pay_source": 0, "pay_platform": 7, "create_time": 60000}'
    frame = wire(spark, ("tb_order", ORDER), ("pay", bad), ("pay", b"{"), ("refund", bad), ("pay", b"\x00\x00"))
    each = envelopes.classify(frame)
    good = envelopes.decode_messages(frame)
    assert rows(each.filter("type <> 'rejected'").select(*good.columns)) == rows(good)
    rejected = envelopes.quarantine(frame, terminals=True)
    assert rows(each.filter("type = 'rejected'").select(*rejected.columns)) == rows(rejected)


def test_timed_triggers_publish_until_stopped(spark, topics, batch_answer, tmp_path):
    """The job runs at an interval, as it does for good, and takes in what comes."""
    job = periodic_report(stream(spark, topics), str(tmp_path), every=0, processingTime="1 second")
    query = job.progress.query
    try:
        assert query.isActive
        query.processAllAvailable()
        assert backlog(query.lastProgress).get("numFilesOutstanding", 0) == 0
        assert rows(job.turnover.current()) == batch_answer["turnover"]
        assert rows(job.ratio.current()) == batch_answer["ratio"]
    finally:
        query.stop()
        job.progress.detach()
    assert job.progress.rows().count() > 1


def test_ratio_alone_at_its_own_interval(spark, topics, batch_answer, tmp_path):
    job = RatioJob(spark, str(tmp_path))
    payments_in = envelopes.decode_payments(stream(spark, topics))
    job.start(payments_in, availableNow=True).awaitTermination()
    assert rows(job.results.current()) == batch_answer["ratio"]


def test_restart_after_some_batches(spark, sf, batch_answer, tmp_path):
    """Stop with half of the messages, restart on all: same answer, nothing twice."""
    path = str(tmp_path / "topics")
    orders = envelopes.encode(fixtures.order_messages(spark, sf), F.col("topic"))
    pays = envelopes.encode(fixtures.payments(spark, sf), "pay")
    messages.publish(pays, path)
    periodic_report(stream(spark, path), str(tmp_path / "job"), keep_settled=False, availableNow=True)
    messages.publish(orders, path)
    job = periodic_report(stream(spark, path), str(tmp_path / "job"), keep_settled=False, availableNow=True)
    assert rows(job.turnover.current()) == batch_answer["turnover"]
    metrics = dict(rows(job.state_report()))
    # What is held is what is open: settled orders and matched payments have left.
    assert metrics["orders_held"] == metrics["open_orders"] == batch_answer["open"]
    assert metrics["pending_payments"] == batch_answer["pending"]


def test_stream_goes_on_from_a_batch_job(spark, sf, batch_answer, tmp_path):
    pays, orders = fixtures.payments(spark, sf), fixtures.order_messages(spark, sf)
    early = F.pmod(F.xxhash64("order_id", "create_time"), F.lit(2)) == 0
    old_pays, old_orders = pays.filter(early), joins.slim_orders(orders.filter(early))
    path = str(tmp_path / "topics")
    messages.publish(envelopes.encode(pays.filter(~early), "pay"), path)
    for keep in (True, False):
        start = backlog_state(old_pays, old_orders, 8, keep)
        job = periodic_report(stream(spark, path), str(tmp_path / f"job{keep}"), groups=8, backlog=start,
                              keep_settled=keep, availableNow=True)
        if keep:
            messages.publish(envelopes.encode(orders.filter(~early), F.col("topic")), path)
            job = periodic_report(stream(spark, path), str(tmp_path / f"job{keep}"), groups=8, keep_settled=keep,
                                  availableNow=True)
        whole = aggregates.minute_trade_by_platform(joins.match_payments(old_pays, old_orders).unionByName(
            job.minutes.current().filter("series like 't%'").selectExpr(
                "0L as order_id", "series as plat", "minute", "value as pay_amount")))
        assert rows(whole) == batch_answer["platform"]
        metrics = dict(rows(job.state_report()))
        assert metrics["open_orders"] == batch_answer["open"]
        assert metrics["pending_payments"] == batch_answer["pending"]
        assert keep == (metrics["orders_held"] > metrics["open_orders"])
        assert metrics["payments_seen"] == pays.count()


def test_failure_inside_a_batch_is_repeated_without_effect(spark, topics, batch_answer, tmp_path):
    """The batch fails after it has written its tables, and runs again."""
    job = ReportJob(stateful(spark, 2), str(tmp_path / "job"))
    process, failed = job.process, []

    def fail_once(batch, batch_id):
        process(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    job.process = fail_once
    with pytest.raises(Exception, match="lost"):
        job.start(stream(spark, topics), availableNow=True).awaitTermination()
    job.progress.detach()
    job.start(stream(spark, topics), availableNow=True).awaitTermination()
    job.progress.detach()
    assert failed and rows(job.turnover.current()) == batch_answer["turnover"]


def test_watermark_bounds_state_and_keeps_ordered_payments(spark, sf, batch_answer, tmp_path):
    source = str(tmp_path / "p")
    fixtures.payments(spark, sf).coalesce(1).sortWithinPartitions("create_time").write.parquet(source)
    read = stateful(spark, 2).readStream.schema(fixtures.payments(spark, sf).schema).parquet(source)
    timed = stream_minute_trade(read, watermark="1 day")
    query = (
        timed.writeStream.outputMode("complete").format("memory").queryName("timed")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(read.sparkSession.table("timed")) == batch_answer["terminal"]


def test_late_payment_changes_every_later_ratio(spark, tmp_path):
    job = RatioJob(spark, str(tmp_path))
    minute = "pay_platform smallint, minute bigint, trade double"
    job.process(spark.createDataFrame([(0, 0, 10.0), (0, 120, 10.0), (1, 60, 5.0), (1, 120, 5.0)], minute), 0)
    assert rows(job.results.current()) == [("ratio_120", 0.5), ("ratio_60", 0.5)]
    job.process(spark.createDataFrame([(1, 0, 10.0)], minute), 1)
    assert rows(job.results.current()) == [("ratio_0", 1.0), ("ratio_120", 1.0), ("ratio_60", 1.5)]


def test_message_filter_serves_streams(spark, topics, tmp_path):
    only = of_type(envelopes.decode_messages(stream(spark, topics)), "pay")
    assert only.isStreaming


def test_combining_keeps_sums_and_collapses_copies():
    import pyarrow as pa

    n = 9000  # all payments of one order, its copies and two rejects
    orders, rejects = 3, 2
    kinds = ["pay"] * n + ["order"] * orders + ["rejected"] * rejects
    none = [None] * (orders + rejects)
    batch_ = pa.RecordBatch.from_pydict({
        "part": pa.array([1] * len(kinds), pa.int32()), "kind": pa.array(kinds),
        "order_id": pa.array([1] * len(kinds), pa.int64()),
        "plat": pa.array([None] * n + ["tb"] * orders + [None] * rejects, pa.string()),
        "total_price": pa.array([None] * n + [5.0] * orders + [None] * rejects, pa.float64()),
        "minute": pa.array([i % 3 * 60 for i in range(n)] + none, pa.int64()),
        "pay_platform": pa.array([0] * n + none, pa.int16()),
        "whole": pa.array([1] * n + none, pa.int64()), "millionths": pa.array([500_000] * n + none, pa.int64()),
        "payments": pa.array([1] * n + none, pa.int64()),
        **{c: pa.array([None] * (n + orders) + ["x"] * rejects, t) for c, t in (
            ("topic", pa.string()), ("reason", pa.string()))},
        "body": pa.array([None] * (n + orders) + [b"x"] * rejects, pa.binary()),
    })
    out = pa.Table.from_batches(list(combine(iter([batch_])))).to_pylist()
    assert sorted((r["minute"], r["whole"], r["millionths"], r["payments"]) for r in out if r["kind"] == "pay") == [
        (m, 3000, 1_500_000_000, 3000) for m in (0, 60, 120)]
    assert [r["total_price"] for r in out if r["kind"] == "order"] == [5.0]
    assert [r["body"] for r in out if r["kind"] == "rejected"] == [b"x"] * 2
