"""The matching of a group on packed columns, against the same rule one row at a time."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tradetide.streaming.matching import CHUNK, OFFERS, PAYS, Group, _unpack, packed

MESSAGE = pa.schema([
    ("part", pa.int32()), ("kind", pa.string()), ("order_id", pa.int64()), ("plat", pa.string()),
    ("total_price", pa.float64()), ("minute", pa.int64()), ("pay_platform", pa.int16()), ("whole", pa.int64()),
    ("millionths", pa.int64()), ("payments", pa.int64()), ("topic", pa.string()), ("body", pa.binary()),
    ("reason", pa.string())])


def columns(items, names):
    return [np.array([item[i] for item in items], dtype) for i, dtype in enumerate(names.values())]


def one_by_one(batches, keep_settled):
    """Orders, waiting minutes and matched sums by dictionaries."""
    orders, waiting, matched = {}, {}, {}
    for pays, offers in batches:
        touched = {order_id for order_id, *_ in offers}
        for order_id, plat, total in sorted(offers, key=lambda o: (o[0], o[1], o[2])):
            if order_id not in orders:
                orders[order_id] = [plat, total, 0]
        paid = {}
        for order_id, minute, _, whole, millionths, n in pays:
            a, m = paid.get((order_id, minute), (0, 0))
            paid[order_id, minute] = a + whole * 10**6 + millionths, m + n
        for key in [key for key in waiting if key[0] in orders]:
            a, m = paid.get(key, (0, 0))
            b, n = waiting.pop(key)
            paid[key] = a + b, m + n
        for key, (a, n) in paid.items():
            if key[0] in orders:
                orders[key[0]][2] += a
                touched.add(key[0])
                matched[key] = tuple(map(sum, zip(matched.get(key, (0, 0)), (a, n))))
            else:
                waiting[key] = tuple(map(sum, zip(waiting.get(key, (0, 0)), (a, n))))
        if not keep_settled:
            for order_id in touched:
                if abs(orders[order_id][1] - float(Fraction(orders[order_id][2], 10**6))) <= 1e-6:
                    del orders[order_id]
    return orders, waiting, matched


@pytest.mark.parametrize("keep_settled", [True, False])
@pytest.mark.parametrize("seed", range(5))
def test_columns_match_as_single_rows_do(keep_settled, seed):
    draw = random.Random(seed)
    batches = [(
        [(draw.randrange(60), draw.randrange(3) * 60, draw.choice([0, 1, 9, -32768]), draw.randrange(-2, 4),
          draw.choice([0, 500_000, 999_999, 2_000_001]), draw.randrange(1, 3)) for _ in range(draw.randrange(80))],
        [(draw.randrange(80), draw.randrange(2), draw.choice([0.0, 1.5, 3.0, 1e12 + 0.1])) for _ in range(draw.randrange(40))])
        for _ in range(6)]
    state, matched = None, {}
    for pays, offers in batches:
        group = Group(state)
        got, _ = group.take(columns(pays, PAYS), columns(offers, OFFERS), keep_settled)
        for order_id, _, minute, whole, millionths, n in zip(*(c.tolist() for c in got)):
            a, m = matched.get((order_id, minute), (0, 0))
            matched[order_id, minute] = a + whole * 10**6 + millionths, m + n
        state = group.state()
    group = Group(state)
    orders, waiting, want = one_by_one(batches, keep_settled)
    assert matched == want
    assert {i: [p, t, w * 10**6 + m] for i, p, t, w, m in zip(*(c.tolist() for c in group.orders))} == orders
    assert {(i, at): (w * 10**6 + m, n) for i, at, w, m, n in zip(*(c.tolist() for c in group.waiting))} == waiting
    assert group.paid_for == sum(p[5] for pays, _ in batches for p in pays)


def test_large_totals_settle_as_doubles_do():
    """At a million million a double has no cents; the sum as a double equals the total."""
    group = Group(None)
    group.take(columns([(1, 0, 0, 10**12, 100_000, 1)], PAYS), columns([(1, 0, 1e12 + 0.1)], OFFERS), False)
    assert len(group.orders[0]) == 0


def test_sums_beyond_a_long_raise():
    group = Group(None)
    with pytest.raises(OverflowError):
        group.take(columns([(1, 0, 0, 9 * 10**18, 0, 1), (1, 0, 0, 9 * 10**18, 0, 1)], PAYS), columns([], OFFERS), True)


def test_rows_of_a_group_travel_as_one():
    """What is shuffled is a row per group and kind, however many Arrow batches a task reads."""
    n, groups = 30_000, 8
    order = [i % 3 == 0 for i in range(n)]
    numbers = {c: [None if o else i for i, o in enumerate(order)] for c in ("minute", "whole", "millionths", "payments")}
    values = {
        "part": [i % groups for i in range(n)], "kind": ["order" if o else "pay" for o in order], "order_id": list(range(n)),
        "plat": ["tm" if o else None for o in order], "total_price": [5.0 if o else None for o in order], **numbers}
    rows = pa.table({f.name: pa.array(values.get(f.name, [None] * n), f.type) for f in MESSAGE})
    assert n < CHUNK
    out = pa.concat_tables(pa.Table.from_batches([b]) for b in packed(iter(rows.to_batches(1000)))).to_pylist()
    assert sorted((r["kind"], r["part"]) for r in out) == [(k, g) for k in ("order", "pay") for g in range(groups)]
    for row in out:
        want = [i for i in range(n) if i % groups == row["part"] and (i % 3 == 0) == (row["kind"] == "order")]
        assert sorted(_unpack([row["order_id"]], "<i8").tolist()) == want
        if row["kind"] == "order":
            assert set(_unpack([row["plat"]], "i1").tolist()) == {1}
        else:
            assert sorted(_unpack([row["whole"]], "<i8").tolist()) == want


def test_backlog_is_one_shuffle_and_no_join(spark):
    from helpers import payments, plan, slim
    from tradetide.streaming.matching import backlog_state

    pays = payments(spark, (1, 3, 0, 0), (1, 7, 1, 60_000), (2, 1, 0, 0), (9, 4, 0, 0))
    orders = slim(spark, (1, "tb", 10), (2, "tm", 9), (2, "tm", 9))
    state = backlog_state(pays, orders, 1, keep_settled=False)._df
    ran = plan(state)
    assert ran.count("Exchange") == 1 and "Join" not in ran
    group = Group(tuple(state.first())[1:])
    assert (group.seen, group.paid_for) == (2, 4)
    assert [c.tolist() for c in group.orders] == [[2], [1], [9.0], [1], [0]]
    assert [c.tolist() for c in group.waiting] == [[9], [0], [4], [0], [1]]


def test_minutes_of_a_task_return_as_one_sum_each():
    """What returns from Python grows with a task's minutes, not with its groups and orders."""
    from tradetide.streaming.matching import MATCHED, OUT_TYPES, TERMINAL, minutes_of

    def row(kind, names, items):
        values = {n: c.tobytes() for n, c in zip(names, columns(items, names))}
        return {"kind": kind, **{n: values.get(n) for n in [*MATCHED, "pay_platform"]}, "topic": None, "body": None, "reason": None}

    given = [
        row("matched", MATCHED, [(1, 0, 60, 2, 999_999, 1), (2, 1, 60, 5, 0, 1), (3, 0, 60, 1, 2, 1)]),
        row("terminal", TERMINAL, [(0, 60, 3, 1, 2), (1, 60, 5, 0, 1)]),
        {**row("rejected", {}, []), "topic": "pay", "body": b"x", "reason": "body"},
        row("matched", MATCHED, [(9, 0, 60, -4, 500_000, 1), (9, 0, 120, 7, 0, 2)]),
        row("terminal", TERMINAL, [(0, 60, 3, 0, 1)])]
    types = {**OUT_TYPES, **dict.fromkeys([*MATCHED, "pay_platform"], pa.binary())}
    batches = [pa.RecordBatch.from_pylist([r], pa.schema([(n, types[n]) for n in r])) for r in given]
    got = pa.Table.from_batches(list(minutes_of(iter(batches)))).to_pylist()
    assert [tuple(r.values()) for r in got if r["kind"] == "rejected"] == [("rejected", None, None, None, None, "pay", b"x", "body")]
    assert sorted(tuple(r.values())[:5] for r in got if r["kind"] != "rejected") == [
        ("matched", "tb", 60, 0, 500_001), ("matched", "tb", 120, 7, 0), ("matched", "tm", 60, 5, 0),
        ("terminal", "0", 60, 6, 1), ("terminal", "1", 60, 5, 0)]
    huge = [row("terminal", TERMINAL, [(0, 60 * i, 9 * 10**18, 0, 1)]) for i in range(2)]
    batches = [pa.RecordBatch.from_pylist([r], pa.schema([(n, types[n]) for n in r])) for r in huge]
    assert [r["whole"] for b in minutes_of(iter(batches)) for r in b.to_pylist()] == [9 * 10**18] * 2


def test_few_columns_go_to_python_and_parsing_stays_in_generated_code(spark):
    from helpers import plan
    from tradetide.sources import envelopes
    from tradetide.streaming.matching import _packed_groups

    wire = spark.createDataFrame([("pay", b'{"order_id": 1}', None)], "topic string, body binary, ts timestamp")
    ran = plan(_packed_groups(envelopes.classify(wire), 4))
    given = ran[ran.index("MapInArrow narrow("):]
    assert given[:given.index(")")].count(",") < 9 and "lambdafunction" not in ran


def test_amounts_split_in_python_as_in_the_jvm(spark):
    from pyspark.sql import functions as F
    from tradetide.functions.money import money_parts
    from tradetide.streaming.matching import widened

    draw = random.Random(3)
    amounts = [0.0, -0.000001, 1e12, 999_999.9999995, 1.005, -7.3, *[draw.uniform(-1e6, 1e6) for _ in range(500)]]
    n = len(amounts)
    batch = pa.RecordBatch.from_pydict({
        "part": pa.array([0] * n, pa.int32()), "code": pa.array([0] * n, pa.int8()), "order_id": pa.array(range(n), pa.int64()),
        "amount": pa.array(amounts), "minute": pa.array([0] * n, pa.int64()), "pay_platform": pa.array([0] * n, pa.int16())})
    table = next(widened(iter([batch])))
    whole, rest = money_parts("a")
    want = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "i int, a double").select("i", whole, rest).orderBy("i").collect()
    assert [tuple(r)[1:] for r in want] == list(zip(table["whole"].to_pylist(), table["millionths"].to_pylist()))
    for bad in (1e15, float("nan"), float("-inf")):
        with pytest.raises(ValueError):
            next(widened(iter([batch.set_column(3, "amount", pa.array([bad] * n))])))
