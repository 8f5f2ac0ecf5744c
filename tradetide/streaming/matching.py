"""Matching payments with orders on a stream, whichever side comes first.

State is kept per group of orders, a hash of the order id, through
``transformWithState``: an order with what was paid on it, and what waits for an
order, summed per minute.  A payment leaves the state when it is matched, so what
is held are the open orders and pending payments and, unless settled orders are
evicted, those.  A micro-batch reads and writes the groups its rows belong to, each
as one value of arrays: with ``groups`` in proportion to the orders held, a group
holds a few hundred and a batch costs what its own rows cost.

Between the tasks and in the state, the rows of a group travel as columns of numbers, each
packed into one binary value, and are matched by NumPy: a row or an order as an object of
its own cost some tens of microseconds at each step.

Amounts are whole units and millionths as integers throughout, so that no result
depends on the order rows arrive in.  Each task sums its payments per order,
minute and terminal, some Arrow batches at a time, before they are shuffled: an order
with a third of all payments reaches its group as sums, bounded by its minutes.

Which order counts: copies of an order are alike and count once.  Should two unlike
orders share an id, the one of the earlier micro-batch counts, and within one the
smaller by platform and total, as in batch; only for such ids does the result
depend on the cut.

The operator passes on what else a report needs, so that one scan and one parse of
the messages feed everything: ``kind`` is ``matched``, ``terminal`` (what the batch
adds to each terminal's minutes, matched or not) or ``rejected``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tradetide import schemas as S
from tradetide.functions import minute_bucket
from tradetide.functions.money import LIMIT, money_of
from tradetide.operators.joins import tagged_union
from tradetide.session import checked_state_session, state_partitions_of

# Groups for each state partition where a job doesn't say: small jobs.
GROUPS_PER_PARTITION = 64
# Rows and bytes a task sums and packs at once, and rows of an unpacked Arrow batch, at most.
CHUNK, CHUNK_BYTES, UNPACKED = 2**18, 2**26, 2**16

KEYS = ["part", "kind", "order_id", "plat", "total_price", "minute", "pay_platform"]
SUMS = ["whole", "millionths", "payments"]
REJECT = ["topic", "body", "reason"]
PLATS = pa.array([S.PLAT_TB, S.PLAT_TM])
NO_TERMINAL = -32768
# What a row is, as the number it goes to Python with, and the platform with it.
KINDS = pa.array(["pay", "order", "order", "rejected", "order"])
KIND_PLATS = pa.array([None, S.PLAT_TB, S.PLAT_TM, None, None], pa.string())
PAY, TB_ORDER, TM_ORDER, REJECTED_ROW, STRAY_ORDER = range(5)

# Columns of packed rows and their types as numbers; a platform is its place in PLATS.
PAYS = {"order_id": "<i8", "minute": "<i8", "pay_platform": "<i2", "whole": "<i8", "millionths": "<i8", "payments": "<i8"}
OFFERS = {"order_id": "<i8", "plat": "i1", "total_price": "<f8"}
MATCHED = {"order_id": "<i8", "plat": "i1", "minute": "<i8", "whole": "<i8", "millionths": "<i8", "payments": "<i8"}
TERMINAL = {"pay_platform": "<i2", "minute": "<i8", "whole": "<i8", "millionths": "<i8", "payments": "<i8"}
# Orders of a group with what was paid on them, by id, and its waiting minutes, by id and minute.
ORDERS = OFFERS | {"paid": "<i8", "paid_millionths": "<i8"}
WAITING = {"late_id": "<i8", "minute": "<i8", "waiting": "<i8", "waiting_millionths": "<i8", "waiting_payments": "<i8"}


def _binaries(names) -> str:
    return ", ".join(f"{name} binary" for name in names)


REJECTED = "topic string, body binary, reason string"
PACKED = f"part int, kind string, {_binaries(OFFERS | PAYS)}, {REJECTED}"
PACKED_OUT = f"kind string, {_binaries(MATCHED | TERMINAL)}, {REJECTED}"
OUT = (
    "kind string, order_id bigint, plat string, minute bigint, pay_platform smallint,"
    " whole bigint, millionths bigint, payments bigint, topic string, body binary, reason string"
)
MINUTES = "kind string, series string, minute bigint, whole bigint, millionths bigint, topic string, body binary, reason string"
OUT_TYPES = {
    "kind": pa.string(), "order_id": pa.int64(), "plat": pa.string(), "minute": pa.int64(), "pay_platform": pa.int16(),
    "whole": pa.int64(), "millionths": pa.int64(), "payments": pa.int64(),
    "topic": pa.string(), "body": pa.binary(), "reason": pa.string()}
# How many orders and payments a group has seen, its orders and its waiting minutes.
STATE = f"orders bigint, payments bigint, {_binaries(ORDERS | WAITING)}"
STATE_NAMES = ["orders", "payments", *(ORDERS | WAITING)]
MILLION = 1_000_000
MOST_UNITS = 9e18  # what a group may add up to at once; sums of whole units beyond might not fit a long


# ------------------------------------------------------------------ packing


def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they leave the JVM, with the columns ``combine`` sums: each column of a row
    costs its way to Python, so that an amount and a code stand for six of them."""
    for batch in batches:
        code, amount, n = batch["code"], batch["amount"], batch.num_rows
        pay = pc.equal(code, PAY)
        paid = pc.if_else(pay, amount, None)
        if pc.all(pc.less(pc.abs(paid), LIMIT)).as_py() is False:
            raise ValueError("amount out of range")
        whole = pc.floor(paid)
        millionths = pc.floor(pc.add(pc.multiply(pc.subtract(paid, whole), float(MILLION)), 0.5))
        lacking = [pa.nulls(n, OUT_TYPES[name]) if name not in batch.schema.names else batch[name] for name in REJECT]
        yield pa.RecordBatch.from_arrays([
            batch["part"], KINDS.take(code), batch["order_id"], KIND_PLATS.take(code), pc.if_else(pay, None, amount),
            batch["minute"], batch["pay_platform"], whole.cast(pa.int64()), millionths.cast(pa.int64()),
            pc.if_else(pay, pa.scalar(1, pa.int64()), None), *lacking], names=[*KEYS, *SUMS, *REJECT])


def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they leave the JVM, packed."""
    return packed(widened(batches))


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the payments of each Arrow batch; copies of an order collapse, rejects pass."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rejected = pc.equal(table["kind"], "rejected")
        rest = table.filter(pc.invert(rejected))
        summed = rest.group_by(KEYS).aggregate([(name, "sum") for name in SUMS])
        summed = summed.select([*KEYS, *[f"{name}_sum" for name in SUMS]]).rename_columns([*KEYS, *SUMS])
        for name in REJECT:
            summed = summed.append_column(name, pa.nulls(len(summed), table.schema.field(name).type))
        whole = pa.concat_tables([summed, table.filter(rejected).select([*KEYS, *SUMS, *REJECT])])
        yield from whole.combine_chunks().to_batches()


def gathered(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together until they have so many rows, or many bytes."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n >= rows or size >= CHUNK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, size = [], 0, 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combined rows as one row per group and kind, its columns packed; rejects one by one."""
    for batch in combine(gathered(batches)):
        table = pa.Table.from_batches([batch])
        for kind, columns in (("pay", PAYS), ("order", OFFERS)):
            rows = table.filter(pc.equal(table["kind"], kind))
            if len(rows):
                yield _pack(rows, kind, columns)
        rejected = table.filter(pc.equal(table["kind"], "rejected"))
        for rows in rejected.combine_chunks().to_batches():
            nothing = pa.nulls(rows.num_rows, pa.binary())
            yield pa.RecordBatch.from_pydict(
                {"part": rows["part"], "kind": rows["kind"], **dict.fromkeys(OFFERS | PAYS, nothing),
                 **{name: rows[name] for name in REJECT}})


def _pack(rows: pa.Table, kind: str, columns: dict[str, str]) -> pa.RecordBatch:
    part = rows["part"].to_numpy()
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = _starts([part])
    ends = np.append(starts, len(part))
    out = {"part": pa.array(part[starts], pa.int32()), "kind": pa.array([kind] * len(starts))}
    for name in OFFERS | PAYS:
        out[name] = pa.nulls(len(starts), pa.binary())
    for name, dtype in columns.items():
        values = np.ascontiguousarray(_numbers(rows, name)[order], dtype)
        offsets = (ends * values.itemsize).astype(np.int32)
        out[name] = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
    for name in REJECT:
        out[name] = pa.nulls(len(starts), OUT_TYPES[name])
    return pa.RecordBatch.from_pydict(out)


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    values = rows[name]
    if name == "plat":
        values = pc.index_in(values, value_set=PLATS)
    elif name == "pay_platform":
        values = pc.fill_null(values, NO_TERMINAL)
    if values.null_count:
        raise ValueError(f"{name} is missing or unknown in {values.null_count} rows")
    return values.to_numpy()


def _unpack(parts: list[bytes | None], dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(part for part in parts if part), dtype)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the operator returns as rows again."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for kind, columns in (("matched", MATCHED), ("terminal", TERMINAL)):
            rows = table.filter(pc.equal(table["kind"], kind))
            found = {name: pa.array(_unpack(rows[name].to_pylist(), dtype)) for name, dtype in columns.items()}
            n = len(found["payments"])
            if "plat" in found:
                found["plat"] = PLATS.take(found["plat"])
            found["kind"] = pa.repeat(kind, n)
            for name, dtype in OUT_TYPES.items():
                if name not in found:
                    found[name] = pa.nulls(n, dtype)
            yield from pa.table({name: found[name] for name in OUT_TYPES}).to_batches(UNPACKED)
        rows = table.filter(pc.equal(table["kind"], "rejected"))
        yield from pa.table({
            name: rows[name] if name in ("kind", *REJECT) else pa.nulls(len(rows), dtype)
            for name, dtype in OUT_TYPES.items()}).to_batches()


def minutes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the operator returns as sums per series and minute of the task; rejects one by one.

    Platforms and terminals are the series, under the names they are kept by."""
    kinds = {"matched": ("plat", MATCHED), "terminal": ("pay_platform", TERMINAL)}
    held = {kind: [] for kind in kinds}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for kind, (series, types) in kinds.items():
            rows = table.filter(pc.equal(table["kind"], kind))
            if len(rows):
                names = [series, "minute", "whole", "millionths", "payments"]
                held[kind].append([_unpack(rows[name].to_pylist(), types[name]) for name in names])
                if sum(len(part[0]) for part in held[kind]) > CHUNK:
                    summed = _series(held[kind])
                    # Mostly other minutes: they go on as they are.
                    if len(summed[0]) > CHUNK // 2:
                        yield from _minute_rows(kind, summed)
                    held[kind] = [] if len(summed[0]) > CHUNK // 2 else [summed]
        rejected = table.filter(pc.equal(table["kind"], "rejected"))
        if len(rejected):
            nothing = {"series": pa.string(), "minute": pa.int64(), "whole": pa.int64(), "millionths": pa.int64()}
            yield from pa.table({
                "kind": rejected["kind"], **{name: pa.nulls(len(rejected), t) for name, t in nothing.items()},
                **{name: rejected[name] for name in REJECT}}).to_batches()
    for kind, parts in held.items():
        if parts:
            yield from _minute_rows(kind, _series(parts))


def _series(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sums per series and minute; what all minutes together might not fit a long stays apart."""
    series, minute, *sums = _joined(*parts)
    if np.abs(sums[0].astype(float)).sum() > MOST_UNITS:
        return [series, minute, *sums]
    return list(_summed([series, minute], sums))


def _minute_rows(kind: str, summed: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    series, minute, whole, millionths, _ = map(pa.array, summed)
    n = len(series)
    series = PLATS.take(series) if kind == "matched" else series.cast(pa.string())
    yield from pa.table({
        "kind": pa.repeat(kind, n), "series": series, "minute": minute, "whole": whole, "millionths": millionths,
        **{name: pa.nulls(n, OUT_TYPES[name]) for name in REJECT}}).to_batches(UNPACKED)


# ----------------------------------------------------------------- matching


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where each run of equal keys begins."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def _find(known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ids in sorted, distinct ones, and whether they are there."""
    at = np.searchsorted(known, ids)
    if not len(known):
        return at, np.zeros(len(ids), bool)
    at = np.minimum(at, len(known) - 1)
    return at, known[at] == ids


def _carried(whole: np.ndarray, millionths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    carry, rest = np.divmod(millionths, MILLION)
    return whole + carry, rest


def _checked(*amounts: np.ndarray) -> None:
    if sum(np.abs(a.astype(float)).sum() for a in amounts) > MOST_UNITS:
        raise OverflowError("amounts of a group don't fit a long")


def _summed(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of whole units, millionths and payments."""
    if not len(keys[0]):
        return *keys, *sums
    _checked(sums[0])
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    starts = _starts(keys)
    whole, millionths, payments = (np.add.reduceat(s[order], starts) for s in sums)
    return *[key[starts] for key in keys], *_carried(whole, millionths), payments


def _joined(*parts) -> list[np.ndarray]:
    return [np.concatenate(columns) for columns in zip(*parts)]


class Group:
    """Orders and waiting payments of one group, opened from the state."""

    def __init__(self, held: tuple | None):
        nothing = (0, 0, *[b""] * len(ORDERS | WAITING))
        self.seen, self.paid_for, *columns = nothing if held is None else held
        values = [np.frombuffer(c, dtype) for c, dtype in zip(columns, (ORDERS | WAITING).values())]
        self.orders, self.waiting = values[:len(ORDERS)], values[len(ORDERS):]

    def state(self) -> tuple:
        columns = zip([*self.orders, *self.waiting], (ORDERS | WAITING).values())
        return self.seen, self.paid_for, *[c.astype(dtype, copy=False).tobytes() for c, dtype in columns]

    def take(self, pays: list[np.ndarray], offers: list[np.ndarray], keep_settled: bool):
        """Take in a batch; what it matches (as MATCHED) and adds to terminals (as TERMINAL)."""
        order_id, minute, terminal, *amounts = pays
        self.paid_for += int(amounts[2].sum())
        known = (terminal == S.TERMINAL_PC) | (terminal == S.TERMINAL_MOBILE)
        terminals = _summed([terminal[known], minute[known]], [a[known] for a in amounts])

        arrived, new = self._arrive(offers)
        woken = _find(new, self.waiting[0])[1]
        paid = _summed(*_keys_sums(_joined([order_id, minute, *amounts], [c[woken] for c in self.waiting])))
        ids, plats, totals, whole, millionths = self.orders
        at, found = _find(ids, paid[0])
        matched = [c[found] for c in paid]
        at = at[found]
        _checked(whole, matched[2])
        whole, millionths = whole.copy(), millionths.copy()
        np.add.at(whole, at, matched[2])
        np.add.at(millionths, at, matched[3])
        self.orders = [ids, plats, totals, *_carried(whole, millionths)]
        still = _joined([c[~woken] for c in self.waiting], [c[~found] for c in paid])
        self.waiting = list(_summed(*_keys_sums(still)))
        if not keep_settled:
            touched = np.zeros(len(ids), bool)
            touched[at] = True
            touched[_find(ids, arrived)[0]] = True
            self._evict(touched)
        return [matched[0], plats[at], *matched[1:]], terminals

    def _arrive(self, offers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Take in new orders, of unlike ones the smaller by platform and total; all ids and the new ones."""
        ids, plats, totals = offers
        order = np.lexsort((totals, plats, ids))
        first = order[_starts([ids[order]])]
        arrived = ids[first]
        new = first[~_find(self.orders[0], arrived)[1]]
        self.seen += len(new)
        none = np.zeros(len(new), np.int64)
        merged = _joined(self.orders, [ids[new], plats[new], totals[new], none, none])
        order = np.argsort(merged[0], kind="stable")
        self.orders = [c[order] for c in merged]
        return arrived, ids[new]

    def _evict(self, touched: np.ndarray) -> None:
        """Settled orders leave.  The difference is that of the amounts as doubles, as in batch."""
        _, _, totals, whole, millionths = self.orders
        about = np.abs((totals - whole) - millionths / MILLION)
        near = np.flatnonzero(touched & (about <= 2 * S.SETTLED_TOLERANCE + 4 * np.spacing(np.abs(totals))))
        settled = [
            abs(total - (units * MILLION + rest) / MILLION) <= S.SETTLED_TOLERANCE
            for total, units, rest in zip(totals[near].tolist(), whole[near].tolist(), millionths[near].tolist())]
        stays = np.ones(len(totals), bool)
        stays[near[np.array(settled, bool)]] = False
        self.orders = [c[stays] for c in self.orders]


def _keys_sums(columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Order id and minute; whole units, millionths and payments."""
    return columns[:2], columns[2:]


class Matcher(StatefulProcessor):
    """Orders and waiting payments of one group."""

    def __init__(self, keep_settled: bool):
        self.keep_settled = keep_settled

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.held.update(tuple(initialState[name] for name in STATE_NAMES))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts = {"pay": [], "order": []}
        for row in rows:
            if row.kind == "rejected":
                yield _out("rejected", topic=row.topic, body=row.body, reason=row.reason)
            else:
                parts[row.kind].append(row)
        group = Group(self.held.get())
        matched, terminals = group.take(
            _columns(parts["pay"], PAYS), _columns(parts["order"], OFFERS), self.keep_settled)
        for kind, columns, names in (("terminal", terminals, TERMINAL), ("matched", matched, MATCHED)):
            if len(columns[0]):
                yield _out(kind, **{
                    name: c.astype(dtype, copy=False).tobytes() for (name, dtype), c in zip(names.items(), columns)})
        self.held.update(group.state())

    def close(self) -> None:
        pass


def _columns(rows: list, names: dict[str, str]) -> list[np.ndarray]:
    return [_unpack([row[name] for row in rows], dtype) for name, dtype in names.items()]


def _out(kind, order_id=None, plat=None, minute=None, pay_platform=None, whole=None, millionths=None, payments=None,
         topic=None, body=None, reason=None) -> Row:
    return Row(
        kind=kind, order_id=order_id, plat=plat, minute=minute, pay_platform=pay_platform, whole=whole,
        millionths=millionths, payments=payments, topic=topic, body=body, reason=reason)


def part_of(key: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")


def _packed_groups(messages: DataFrame, groups: int) -> DataFrame:
    """Messages by group, summed and packed."""
    kind = F.col("type")
    pay, rejects = kind == "pay", [c for c in REJECT if c in messages.columns]
    rows = messages.filter(
        (kind == "rejected") | (F.col("order_id").isNotNull() & (pay | F.col("total_price").isNotNull())))
    order = F.when(F.col("plat") == S.PLAT_TB, TB_ORDER).when(F.col("plat") == S.PLAT_TM, TM_ORDER).otherwise(STRAY_ORDER)
    key = F.coalesce("order_id", F.xxhash64("body")) if "body" in rejects else F.col("order_id")
    slim = rows.select(
        part_of(key, groups).alias("part"),
        F.when(pay, PAY).when(kind == "order", order).when(kind == "rejected", REJECTED_ROW).cast("tinyint").alias("code"),
        "order_id", F.when(pay, F.col("pay_amount")).when(kind == "order", F.col("total_price")).alias("amount"),
        F.when(pay, minute_bucket("create_time")).alias("minute"),
        F.when(pay, F.col("pay_platform")).cast("smallint").alias("pay_platform"), *rejects)
    return slim.mapInArrow(narrow, PACKED)


def _operated(
    messages: DataFrame, groups: int | None = None, keep_settled: bool = True, backlog: GroupedData | None = None
) -> DataFrame:
    """Messages through the stateful operator, its rows still packed."""
    spark = checked_state_session(messages)
    groups = groups or GROUPS_PER_PARTITION * state_partitions_of(spark)
    more = {} if backlog is None else {"initialState": backlog}
    return _packed_groups(messages, groups).groupBy("part").transformWithState(
        Matcher(keep_settled), PACKED_OUT, "Append", "None", **more)


def tagged_stream(
    messages: DataFrame, groups: int | None = None, keep_settled: bool = True, backlog: GroupedData | None = None
) -> DataFrame:
    """Tagged messages to ``kind`` rows: what they match, add to terminals, and rejects.

    ``messages`` are those of ``decode_messages`` or ``classify``, read in a session of
    ``session.stateful``.  ``groups`` is fixed for good by the first start, as the number
    of state partitions is.  Without ``keep_settled`` an order leaves the state when it is
    paid in full; its later payments then wait for good, so the result depends on the cut.
    ``backlog`` is the state to start from (``backlog_state``); later starts ignore it.
    """
    out = _operated(messages, groups, keep_settled, backlog).mapInArrow(unpacked, OUT)
    amount = money_of(F.col("whole"), F.col("millionths"))
    return out.select(
        "kind", "order_id", "plat", "minute", "pay_platform", amount.alias("pay_amount"), "payments", *REJECT)


def minute_stream(messages: DataFrame, **options) -> DataFrame:
    """``tagged_stream`` for who needs no orders: what a batch adds to each minute of a
    ``series``, a platform's or a terminal's, in ``whole`` units and ``millionths``, and
    rejects.  Each task sums its groups before anything returns from Python."""
    return _operated(messages, **options).mapInArrow(minutes_of, MINUTES)


def matched_stream(messages: DataFrame, **options) -> DataFrame:
    """Every payment of a stream whose order arrives, summed per order and minute of a batch."""
    matched = tagged_stream(messages, **options).filter("kind = 'matched'")
    return matched.select("order_id", "plat", "minute", "pay_amount", "payments")


def backlog_state(payments: DataFrame, orders: DataFrame, groups: int, keep_settled: bool = True) -> GroupedData:
    """What a batch job leaves over, as the state a stream starts from.

    The batch takes in all of ``payments`` and ``orders`` (``match_payments`` gives what
    it matched); the stream goes on with the rest, with the same ``groups``.
    """
    messages = tagged_union(payments, orders)

    def first(rows: pa.Table) -> pa.Table:
        part, kinds = rows["part"][0], rows["kind"]
        columns = [
            [_unpack(rows.filter(pc.equal(kinds, kind))[name].to_pylist(), dtype) for name, dtype in names.items()]
            for kind, names in (("pay", PAYS), ("order", OFFERS))]
        group = Group(None)
        group.take(*columns, keep_settled)
        return pa.table({"part": [part], **{n: [v] for n, v in zip(STATE_NAMES, group.state())}}).cast(
            pa.schema([("part", pa.int32()), ("orders", pa.int64()), ("payments", pa.int64()),
                       *[(name, pa.binary()) for name in ORDERS | WAITING]]))

    return _packed_groups(messages, groups).groupBy("part").applyInArrow(first, f"part int, {STATE}").groupBy("part")


def held(spark: SparkSession, checkpoint: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, waiting minutes and numbers seen in the state of a ``tagged_stream`` query."""
    state = (
        spark.read.format("statestore").option("stateVarName", "held").load(checkpoint).select("value.*"))

    def opened(names: dict[str, str]):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = {name: pa.array(_unpack(batch[name].to_pylist(), dtype)) for name, dtype in names.items()}
                if "plat" in found:
                    found["plat"] = PLATS.take(found["plat"])
                yield from pa.table(found).to_batches(UNPACKED)
        return state.select(*names).mapInArrow(rows, ", ".join(
            f"{name} {'string' if name == 'plat' else 'double' if name == 'total_price' else 'bigint'}" for name in names))

    def amount(name: str) -> Column:
        return money_of(F.col(name), F.col(f"{name}_millionths")).cast("double")

    orders = opened(ORDERS).select("order_id", "plat", "total_price", amount("paid").alias("paid"))
    late = opened(WAITING).select(
        F.col("late_id").alias("order_id"), "minute", amount("waiting").alias("pay_amount"),
        F.col("waiting_payments").alias("payments"))
    return orders, late, state.select("orders", "payments")


def stream_match(messages: DataFrame, path: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Write matched payments, summed per order and minute, batch by batch.

    Each micro-batch owns the folder ``matched/batch_id=N`` below ``path``.
    """
    path = path.rstrip("/")

    def process(matched: DataFrame, batch_id: int) -> None:
        matched.write.mode("overwrite").parquet(f"{path}/matched/batch_id={batch_id}")

    return (
        matched_stream(messages, **options)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
