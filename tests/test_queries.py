"""Every registered query against its SQL, and the shape of the plans."""

import pytest
from helpers import SF, payments, plan

from pyspark.sql.streaming import StreamingQuery

import __spark_entry__ as spark_entry
from check_results import compare, connect
from tradetide.catalog.oracle import ORACLE
from tradetide import session
from tradetide.catalog import queries as catalog
from tradetide.catalog.queries import QUERIES
from tradetide.operators import aggregates, joins, series
from tradetide.sources import fixtures


STREAMS = {
    "ingest_topics", "tail_topic", "stream_minute_trade", "stream_match", "stream_match_keyed", "stream_match_backlog",
    "periodic_report", "state_report", "reconcile_job", "catch_up"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= spark_entry.queries().items() and ORACLE.items() <= spark_entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name, monkeypatch):
    ran, wait = [], StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda q, *a: (ran.append(q), wait(q, *a))[1])
    assert compare(spark, con, name, SF) == ""
    # A stream passes several micro-batches, whatever the size of its input.
    assert bool(ran) == (name in STREAMS)
    assert name == "catch_up" or all(len(q.recentProgress) >= 5 for q in ran)


@pytest.mark.parametrize("name", ["stream_match_backlog"])
def test_streams_grow_in_partitions_and_not_in_batches(spark, con, name, monkeypatch):
    """Larger tables mean more files, state partitions and groups, and five batches still, none of them a small rest."""
    work, ran, wait = [], [], StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda q, *a: (ran.append(q), wait(q, *a))[1])
    monkeypatch.setattr(catalog, "work_dir", lambda *a: (work.append(session.work_dir(*a)), work[-1])[1])
    monkeypatch.setattr(catalog, "PARTITION_BYTES", 15_000, raising=False)
    monkeypatch.setattr(catalog, "FILE_BYTES", 3_500, raising=False)
    assert compare(spark, con, name, SF) == ""
    files = catalog._length(spark, f"{work[0]}/topics")
    wanted = -(-files.total // 15_000)
    pays = spark.read.format("binaryFile").load(f"{work[0]}/topics/topic=pay").count()
    assert wanted > 8 and pays > 16
    batches = [p for p in ran[0].recentProgress if p.numInputRows]
    assert len(batches) == 5 and min(p.numInputRows for p in batches) > sum(p.numInputRows for p in batches) / 10
    operator = batches[-1].stateOperators[0]
    assert operator.numShufflePartitions == wanted and operator.numRowsTotal > 8 * 64


def test_rows_that_compress_well_come_in_as_many_files(spark, tmp_path, monkeypatch):
    """Tasks of a batch are made of files: their number follows the rows, however few bytes these take."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 100, raising=False)
    rows = sum(fixtures.table(spark, SF, name).count() for name in ("events", "orders"))
    catalog._published(spark, SF, f"{tmp_path}/topics")
    pays = spark.read.format("binaryFile").load(f"{tmp_path}/topics/topic=pay").count()
    assert 16 < pays <= -(-rows // 100) + 1 and catalog.FILES < 16


def test_batches_leave_no_rest():
    assert catalog._batch_bytes(45 * 10, 10) == 100
    assert catalog._batch_bytes(45 * 10, 200) == 111
    assert catalog._batch_bytes(2**40, 2**27) == catalog.MOST_BYTES


def test_entry_returns_ratios(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["minute", "ratio"] and frame.count() > 0


def test_scan_reads_needed_columns_and_filters(spark, sf):
    ran = plan(aggregates.minute_trade_by_terminal(fixtures.payments(spark, sf)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in ran
    assert "GreaterThan(value,0.0)" in ran
    assert ran.count("Exchange") == 1 and "PythonUDF" not in ran


def test_ratio_reads_payments_once(spark, sf):
    ran = plan(series.mobile_pc_ratio(
        aggregates.minute_trade_by_terminal(fixtures.payments(spark, sf))))
    assert ran.count("FileScan") == 1 and "ReusedExchange" in ran


def test_balances_need_one_shuffle_and_no_join(spark, sf):
    slim = joins.slim_orders(fixtures.table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_id", "o_totalprice as total_price", "'tb_order' as topic"))
    ran = plan(joins.open_orders(fixtures.payments(spark, sf), slim))
    assert ran.count("Exchange") == 1 and "Join" not in ran and "SortAggregate" not in ran


def test_no_operator_plans_a_cross_join(spark, sf):
    for name in ("mobile_pc_ratio", "running_minute_trade", "reconcile_totals", "rematch_pending"):
        ran = plan(spark_entry.queries()[name](spark, sf))
        assert "CartesianProduct" not in ran and "NestedLoop" not in ran
