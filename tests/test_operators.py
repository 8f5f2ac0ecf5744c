"""Hand-written rows for every batch operator."""

import pytest
from helpers import payments, plan, rows, slim
from pyspark.sql import functions as F

from tradetide.operators import aggregates, filters, joins, reconcile, series
from tradetide.plans import reports

MS = 60_000


def test_order_and_its_payments_match(spark):
    p = payments(spark, (1, 3, 0, 0), (1, 7, 1, MS), (2, 5, 0, 0))
    o = slim(spark, (1, "tb", 10))
    assert rows(joins.match_payments(p, o)) == [(1, "tb", 0, 3.0), (1, "tb", 60, 7.0)]
    assert rows(joins.pending_payments(p, o).select("order_id")) == [(2,)]
    assert rows(joins.settled_orders(p, o)) == [(1, "tb", 10.0, 10.0)]
    assert rows(joins.open_orders(p, o)) == []


def test_settled_within_tolerance(spark):
    p = payments(spark, (1, 9.9999995, 0, 0), (2, 9.99999, 0, 0))
    o = slim(spark, (1, "tb", 10), (2, "tb", 10), (3, "tm", 0), (4, "tm", 1))
    assert [r[0] for r in rows(joins.settled_orders(p, o))] == [1, 3]
    assert [r[0] for r in rows(joins.open_orders(p, o))] == [2, 4]


def test_overpayment_counts_in_batch(spark):
    p = payments(spark, (1, 10, 0, 0), (1, 2, 0, MS))
    assert joins.match_payments(p, slim(spark, (1, "tm", 10))).count() == 2


def test_redelivered_order_matches_once(spark):
    p = payments(spark, (1, 4, 0, 0))
    o = slim(spark, (1, "tm", 10), (1, "tm", 10))
    assert rows(joins.match_payments(p, o)) == [(1, "tm", 0, 4.0)]
    assert rows(joins.open_orders(p, o)) == [(1, "tm", 10.0, 4.0)]


def test_conflicting_orders_resolve_the_same_way_everywhere(spark):
    o = slim(spark, (1, "tm", 1), (1, "tb", 9), (1, "tb", 8))
    assert rows(joins.unique_orders(o)) == [(1, "tb", 8.0)]
    assert rows(joins.order_balances(payments(spark, (1, 8, 0, 0)), o)) == [(1, "tb", 8.0, 8.0)]


def test_rematch_moves_only_what_arrived(spark):
    pending = payments(spark, (1, 4, 0, 0), (2, 5, 0, 0))
    matched, still = joins.rematch_pending(pending, slim(spark, (2, "tb", 5)))
    assert rows(matched) == [(2, "tb", 0, 5.0)]
    assert rows(still.select("order_id")) == [(1,)]


def test_orders_seen(spark):
    ids = spark.createDataFrame([(1,), (2,)], "order_id bigint")
    assert rows(joins.orders_seen(ids, slim(spark, (2, "tb", 1), (2, "tb", 1)))) == [(2,)]


def test_total_check_lists_mismatches(spark):
    p = payments(spark, (1, 4, 0, 0), (1, 6, 1, 0), (2, 4, 0, 0))
    o = slim(spark, (1, "tb", 10), (2, "tb", 10))
    assert [r[0] for r in rows(joins.order_total_check(p, o))] == [2]


def test_tagged_union_drops_rows_without_id(spark):
    p = payments(spark, (1, 4, 0, 0), (None, 4, 0, 0))
    tagged = joins.tagged_union(p, slim(spark, (2, "tb", 1), (None, "tb", 1)))
    assert rows(tagged.select("type", "order_id")) == [("order", 2), ("pay", 1)]
    assert rows(filters.of_type(tagged, "order").select("order_id")) == [(2,)]
    assert rows(aggregates.message_counts(tagged)) == [("order", "tb", 1), ("pay", None, 1)]


def test_terminal_codes(spark):
    p = payments(spark, (1, 1, 0, 0), (2, 1, 1, 0), (3, 1, 9, 0), (4, 1, None, 0))
    assert rows(filters.valid_terminals(p).select("order_id", "terminal")) == [
        (1, "pc"), (2, "mobile")]
    assert rows(filters.invalid_terminals(p).select("order_id")) == [(3,), (4,)]


def test_amount_check(spark):
    p = payments(spark, (1, 1, 0, 0), (2, 0, 0, 0), (3, -1, 0, 0), (4, 2, 0, 0))
    assert rows(filters.amount_check(p)) == [(2, 1, 1)]
    assert filters.positive_amounts(p).count() == 2


def test_turnover_uses_matched_and_ratio_all_payments(spark):
    p = payments(spark, (1, 3, 0, 0), (2, 5, 0, 0), (1, 4, 9, 0))
    o = slim(spark, (1, "tb", 10))
    matched = joins.match_payments(p, o)
    assert rows(aggregates.minute_trade_by_platform(matched)) == [("tb", 0, 7.0)]
    assert rows(aggregates.minute_trade_by_terminal(p)) == [(0, 0, 8.0)]
    assert rows(aggregates.distinct_minutes(p)) == [(1,)]
    assert rows(aggregates.paid_per_order(p)) == [(1, 7.0), (2, 5.0)]
    assert rows(aggregates.turnover_keys(matched)) == [("platform_tb_0",)]
    assert rows(reports.turnover(p, o, prefix_tb="a_", prefix_tm="b_")) == [("a_0", 7.0)]


def series_of(spark, *items):
    return spark.createDataFrame(
        [(t, m, float(v)) for t, m, v in items],
        "pay_platform smallint, minute bigint, trade double",
    )


def test_ratio_covers_the_intersection_and_carries_totals(spark):
    s = series_of(spark, (0, 0, 10), (0, 180, 10), (1, 60, 5), (1, 240, 5))
    assert rows(series.mobile_pc_ratio(s)) == [(60, 0.5), (120, 0.5), (180, 0.25)]


def test_compat_ratio_counts_first_minutes_twice(spark):
    s = series_of(spark, (0, 0, 10), (0, 60, 10), (1, 0, 5), (1, 60, 15))
    assert rows(series.mobile_pc_ratio(s)) == [(0, 0.5), (60, 1.0)]
    assert rows(series.mobile_pc_ratio_compat(s)) == [(0, 0.5), (60, 25 / 30)]


def test_no_ratio_without_both_terminals_or_with_zero_pc(spark):
    assert rows(series.mobile_pc_ratio(series_of(spark, (1, 0, 5)))) == []
    assert rows(series.mobile_pc_ratio(series_of(spark, (0, 0, 0), (1, 0, 5)))) == []


def test_dense_and_cumulative_across_days(spark):
    day = 86400
    s = series_of(spark, (0, day - 60, 1), (0, day + 60, 2), (0, 3 * day, 4))
    dense = rows(series.dense_minutes(s, "pay_platform"))
    assert [r[1] for r in dense] == list(range(day - 60, 3 * day + 60, 60))
    assert {r[1]: r[2] for r in dense if r[2]} == {day - 60: 1.0, day + 60: 2.0, 3 * day: 4.0}
    cumulative = {r[1]: r[2] for r in rows(series.cumulative_trade(s, "pay_platform"))}
    assert cumulative[day] == 1.0 and cumulative[3 * day - 60] == 3.0 and cumulative[3 * day] == 7.0
    assert rows(series.ladder_sum(s)) == [(day - 60, 1.0), (day + 60, 3.0), (3 * day, 7.0)]
    assert rows(series.latest_key(s)) == [(3 * day, 7.0)]
    assert rows(aggregates.minute_bounds(s, "pay_platform")) == [(0, day - 60, 3 * day)]


def test_ratio_join_equals_the_ratio(spark):
    s = series_of(spark, (0, 0, 8), (0, 120, 8), (1, 60, 4), (1, 240, 4))
    dense = series.cumulative_trade(s, "pay_platform")
    joined = joins.ratio_join(
        dense.filter("pay_platform = 1"), dense.filter("pay_platform = 0")
    ).selectExpr("minute", "mobile_trade / pc_trade")
    assert rows(joined) == rows(series.mobile_pc_ratio(s))


def test_sort_and_union(spark):
    s = series_of(spark, (0, 120, 1), (0, 0, 1), (0, 60, 1))
    assert [r["minute"] for r in series.sort_series(s).collect()] == [0, 60, 120]
    a = spark.createDataFrame([("a",), ("b",)], "key string")
    b = spark.createDataFrame([("b",), ("c",)], "key string")
    assert rows(series.key_union(a, b)) == [("a",), ("b",), ("c",)]


def test_running_minute_trade_against_brute_force(spark):
    items = [(i % 7, (i * 37 % 100) / 4, i % 2, i * 7919 % 200_000) for i in range(500)]
    p = payments(spark, *items)
    got = rows(aggregates.running_minute_trade(p))
    source = sorted(rows(p), key=lambda r: (r[3], r[4] // MS, r[4], r[0], r[2], r[1]))
    want, sums = [], {}
    for order_id, amount, source_, terminal, at in source:
        key = (terminal, at // MS * 60)
        sums[key] = sums.get(key, 0.0) + amount
        want.append((*key, at, order_id, source_, amount, sums[key]))
    assert got == sorted(want)


def test_reconcile_counts_missing_as_error(spark):
    expected = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "key string, expected double")
    actual = spark.createDataFrame([("a", 1.5), ("z", 9.0)], "key string, value double")
    compared = reconcile.reconcile(expected, actual)
    assert rows(reconcile.reconcile_totals(compared)) == [(2, 1, 3.0, 2.5)]
    assert rows(reconcile.reconcile_ratio(expected, actual)) == [(2, 1, 1, 0.5)]


def test_expected_results_need_no_join(spark):
    p = payments(spark, (1, 3, 0, 0), (2, 0, 1, MS)).withColumn("plat", F.lit("tb"))
    assert rows(aggregates.expected_by_platform(p)) == [("tb", 0, 3.0), ("tb", 60, 0.0)]
    assert rows(aggregates.expected_by_terminal(p)) == [(0, 0, 3.0), (1, 60, 0.0)]


def test_hot_order_is_split_by_adaptive_execution(spark):
    """A third of the payments and of the order copies belong to one order."""
    hot = "case when id % 3 = 0 then 7 else id end as order_id"
    p = spark.range(0, 600_000, 1, 8).selectExpr(
        hot, "(id % 100) / 4.0D as pay_amount", "1704067200000 + id * 10 as create_time")
    o = spark.range(0, 600_000, 1, 8).selectExpr(hot, "'tb' as plat", "1.0D as total_price")
    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        matched = aggregates.minute_trade_by_platform(joins.match_payments(p, o))
        assert "skew=true" in plan(matched)
        assert matched.agg(F.sum("trade")).first()[0] == 600_000 * 99 / 8
        pending = joins.pending_payments(p, o.filter("order_id >= 300000"))
        assert "skew=true" in plan(pending)
        assert pending.count() == 400_000
        assert pending.filter("order_id = 7").count() == 200_001  # every third id, and 7
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_bucketed_tables_match_without_a_shuffle(spark, tmp_path):
    p = spark.range(5000).selectExpr(
        "id div 2 as order_id", "1.5D as pay_amount", "id * 1000 as create_time")
    o = spark.range(2000).selectExpr("id as order_id", "'tm' as plat", "3.0D as total_price")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame, name in ((p, "bucketed_payments"), (o, "bucketed_orders")):
            (frame.write.mode("overwrite").option("path", str(tmp_path / name))
             .bucketBy(4, "order_id").sortBy("order_id").saveAsTable(name))
        matched = joins.match_payments(
            spark.table("bucketed_payments"), spark.table("bucketed_orders"), colocated=True)
        assert "Exchange" not in plan(matched)
        assert rows(matched) == rows(joins.match_payments(p, o))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table if exists bucketed_payments")
        spark.sql("drop table if exists bucketed_orders")


def test_one_order_at_one_instant_is_spread_over_many_windows(spark):
    """A third of all payments are one order's, at one time; some are equal in everything."""
    hot = "case when id % 3 = 0 then 7 else id end as order_id"
    p = spark.range(0, 30_000, 1, 4).selectExpr(
        hot, "cast(case when id % 3 = 0 then id % 997 / 4.0D else 1.5D end as double) as pay_amount",
        "cast(null as smallint) as pay_source", "cast(0 as smallint) as pay_platform",
        "1704067200000 as create_time")
    running = aggregates.running_minute_trade(p)
    got = running.orderBy("running_trade", "order_id").collect()
    assert len(got) == 30_000
    total, want = 0.0, sorted((r.order_id, r.pay_amount) for r in p.collect())
    sums = []
    for _, amount in want:
        total += amount
        sums.append(total)
    assert sorted(r.running_trade for r in got) == pytest.approx(sorted(sums), abs=1e-6)
    parts = p.filter("order_id = 7").selectExpr("floor(pay_amount)").distinct().count()
    assert parts > 200 and "part" in running._jdf.queryExecution().toString()


def test_hot_minute_is_spread_over_many_windows(spark):
    """All payments fall into one minute: no window may hold a whole minute."""
    p = spark.range(0, 60_000, 1, 8).selectExpr(
        "id as order_id", "1.0D as pay_amount", "cast(0 as smallint) as pay_source",
        "cast(id % 2 as smallint) as pay_platform", "id as create_time")
    running = aggregates.running_minute_trade(p)
    windows = [line for line in plan(running).splitlines() if "running_trade" in line and "Window" in line]
    spec = windows[0].split("windowspecdefinition(")[1].split(" ASC")[0]
    assert len(spec.split(",")) >= 5  # terminal, minute, millisecond, order range, then the order
    top = running.agg(F.max("running_trade"), F.countDistinct("running_trade")).first()
    assert tuple(top) == (30_000.0, 30_000)


def test_random_series_against_brute_force(spark):
    """Random gaps over several days: the tiers must not show in the result."""
    import random

    rng = random.Random(3)
    items = {}
    for _ in range(400):
        items[(rng.randrange(2), rng.randrange(5 * 1440) * 60)] = rng.randrange(1, 10_000) / 100
    s = series_of(spark, *[(t, m, v) for (t, m), v in items.items()])
    want, first = {}, {}
    for terminal in (0, 1):
        minutes = sorted(m for t, m in items if t == terminal)
        first[terminal] = round(items[(terminal, minutes[0])] * 100)
        cents = 0
        for minute in range(minutes[0], minutes[-1] + 60, 60):
            cents += round(items.get((terminal, minute), 0) * 100)
            want[(terminal, minute)] = cents
    got = rows(series.cumulative_trade(s, "pay_platform"))
    assert got == sorted((t, m, c / 100) for (t, m), c in want.items())
    both = [m for t, m in want if t == 0 and (1, m) in want]
    assert rows(series.mobile_pc_ratio(s)) == [
        (m, (want[(1, m)] / 100) / (want[(0, m)] / 100)) for m in sorted(both)]
    assert rows(series.mobile_pc_ratio_compat(s)) == [
        (m, ((want[(1, m)] + first[1]) / 100) / ((want[(0, m)] + first[0]) / 100))
        for m in sorted(both)]


def test_gap_of_years_is_filled(spark):
    s = series_of(spark, (0, 0, 1), (0, 86400 * 3650, 2))
    dense = series.cumulative_trade(s, "pay_platform")
    assert dense.agg(F.count("*"), F.countDistinct("minute"), F.min("cum_trade"), F.max("cum_trade")).first() == (
        1440 * 3650 + 1, 1440 * 3650 + 1, 1.0, 3.0)
