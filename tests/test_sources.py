from helpers import plan, rows
from pyspark.sql import functions as F

from tradetide import functions as fn
from tradetide import schemas as S
from tradetide.operators import aggregates, joins, reconcile
from tradetide.plans import reports
from tradetide.sinks import messages
from tradetide.sources import envelopes, fixtures, generator


def wire(spark, *items):
    """Envelopes from (topic, body) pairs."""
    data = [(bytearray(body), None, topic) for topic, body in items]
    return spark.createDataFrame(data, S.ENVELOPE)


PAY = b'{"order_id":1,"pay_amount":2.5,"pay_source":0,"pay_platform":1,"create_time":60000}'
ORDER = b'{"order_id":1,"buyer_id":"b","total_price":2.5,"create_time":1}'


def test_markers_broken_bodies_and_unknown_topics(spark):
    w = wire(
        spark,
        ("pay", PAY), ("pay", b"\x00\x00"), ("pay", b"\x00"), ("pay", b"{}"), ("pay", b"junk"),
        ("tb_order", ORDER), ("tb_order", b"\x00\x00"), ("tm_order", PAY), ("refund", ORDER),
        ("pay", PAY.replace(b"2.5", b"NaN")), ("tm_order", ORDER.replace(b"2.5", b"Infinity")),
    )
    assert rows(envelopes.decode_payments(w)) == [(1, 2.5, 0, 1, 60000)]
    assert rows(envelopes.decode_orders(w).select("order_id", "buyer_id", "topic")) == [
        (1, "b", "tb_order")]
    assert rows(envelopes.decode_messages(w).select("type", "order_id", "plat")) == [
        ("order", 1, "tb"), ("pay", 1, None)]
    assert rows(envelopes.quarantine(w).groupBy("topic", "reason").count()) == [
        ("pay", "amount", 1), ("pay", "body", 3), ("refund", "topic", 1), ("tm_order", "amount", 1),
        ("tm_order", "body", 1)]
    assert rows(envelopes.topic_progress(w)) == [
        ("pay", 5, True), ("refund", 1, False), ("tb_order", 1, True), ("tm_order", 2, False)]


def test_nothing_is_lost_between_decoding_and_quarantine(spark, sf):
    from tradetide.catalog import queries

    w = queries._wire(spark, sf)
    total = envelopes.decode_messages(w).count() + envelopes.quarantine(w).count()
    assert total == envelopes.drop_end_markers(w).count()


def test_encode_then_decode_gives_the_records_back(spark, sf):
    p = fixtures.payments(spark, sf)
    o = fixtures.order_messages(spark, sf)
    assert rows(envelopes.decode_payments(envelopes.encode(p, "pay"))) == rows(p)
    assert rows(envelopes.decode_orders(envelopes.encode(o, F.col("topic")))) == rows(o)


def test_reading_topics_opens_only_their_folders(spark, tmp_path):
    w = wire(spark, ("pay", PAY), ("tb_order", ORDER), ("tm_order", ORDER))
    messages.publish(w, str(tmp_path / "t"))
    read = envelopes.read_topics(spark, str(tmp_path / "t"), ["pay"])
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(topic" in plan(read)


def test_catch_up_continues_after_its_checkpoint(spark, tmp_path):
    topics, copy, checkpoint = (str(tmp_path / x) for x in ("t", "c", "k"))
    for count in (1, 2):
        messages.publish(wire(spark, ("pay", PAY)), topics)
        envelopes.catch_up(envelopes.stream_topics(spark, topics, max_bytes=1), copy, checkpoint)
        assert spark.read.parquet(copy).count() == count


def test_tail_topic_shows_every_message_in_full(spark, tmp_path):
    many = [("pay", PAY)] * 50 + [("pay", b"x" * 500), ("tb_order", ORDER)]
    messages.publish(wire(spark, *many), str(tmp_path / "t"))
    source = envelopes.stream_topics(spark, str(tmp_path / "t"))
    query = envelopes.tail_topic(source, "pay", str(tmp_path / "shown"), str(tmp_path / "k"))
    try:
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    shown = [r.body for r in spark.read.schema(envelopes.SHOWN).json(str(tmp_path / "shown")).collect()]
    assert len(shown) == 51 and "x" * 500 in shown


def test_hello_rate_runs(spark):
    query = generator.hello_rate(spark, 5).select(fn.concat_world("message").alias("m"))
    running = query.writeStream.format("memory").queryName("greetings").start()
    try:
        for _ in range(100):
            running.processAllAvailable()
            if spark.table("greetings").count():
                break
        assert {r[0] for r in spark.table("greetings").limit(5).collect()} == {"HelloWorld"}
    finally:
        running.stop()


def test_generated_rows_are_the_same_in_any_partitioning(spark):
    few = generator.gen_payments(generator.gen_orders(generator.indexes(spark, 3000, 1), seed=5))
    many = generator.gen_payments(generator.gen_orders(generator.indexes(spark, 3000, 8), seed=5))
    assert rows(few) == rows(many)


def test_generated_values_stay_in_range_and_spread(spark):
    orders = generator.gen_orders(generator.indexes(spark, 20_000))
    low, high, buyers, tb = orders.agg(
        F.min("total_price"), F.max("total_price"), F.countDistinct("buyer_id"),
        F.count_if(F.col("topic") == "tb_order"),
    ).first()
    assert 0.1 <= low < 50 and 99_950 < high <= 100_000.1
    assert buyers > 8_000 and 9_500 < tb < 10_500
    payments = generator.gen_payments(orders)
    assert payments.filter("pay_amount < 0").count() == 0
    assert rows(joins.order_total_check(payments, joins.slim_orders(orders))) == rows(
        joins.slim_orders(orders).filter("total_price < 2").withColumn("paid", F.lit(0.0)))


def test_an_order_too_small_to_split_has_no_payments(spark):
    order = generator.gen_orders(generator.indexes(spark, 1)).withColumn(
        "total_price", F.lit(1.99))
    assert generator.gen_payments(order).count() == 0


def test_pipeline_reproduces_the_expected_results(spark, tmp_path):
    """Generate, publish, read back, report: nothing missing, no error."""
    orders = generator.gen_orders(generator.indexes(spark, 3000), step_ms=700)
    generated = generator.gen_payments(orders)
    path = str(tmp_path / "topics")
    messages.publish_messages(orders, generated, path)
    read = envelopes.read_topics(spark, path)
    actual = reports.turnover(
        envelopes.decode_payments(read), joins.slim_orders(envelopes.decode_orders(read)))
    expected = aggregates.expected_by_platform(
        generated.withColumn("plat", fn.trade_platform("topic")))
    expected = reports.turnover_rows(expected.withColumnRenamed("expected", "trade"))
    compared = reconcile.reconcile(expected.withColumnRenamed("value", "expected"), actual)
    keys, missing, total, error = reconcile.reconcile_totals(compared).first()
    assert keys > 50 and missing == 0 and total > 0 and error == 0
    assert rows(envelopes.topic_progress(read).select("topic", "ended")) == [
        ("pay", True), ("tb_order", True), ("tm_order", True)]
