import pytest
from helpers import rows

from tradetide.session import configure, work_dir
from tradetide.sinks import messages
from tradetide.sinks.results import KeyedTable, result_table


def kv(spark, **values):
    return spark.createDataFrame([(k, v) for k, v in values.items()], "key string, value double")


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


@pytest.fixture
def table(spark, tmp_path):
    return result_table(spark, str(tmp_path / "results"))


def test_latest_batch_wins_and_replay_changes_nothing(spark, table):
    assert rows(table.current()) == []
    table.upsert(kv(spark, a=1.0, b=2.0), 0)
    table.upsert(kv(spark, a=3.0), 1)
    table.upsert(kv(spark, a=3.0), 1)
    assert rows(table.current()) == [("a", 3.0), ("b", 2.0)]
    assert rows(table.current(upto=0)) == [("a", 1.0), ("b", 2.0)]
    assert table.history().count() == 3


def test_only_changes_are_written(spark, table):
    table.upsert(kv(spark, a=1.0, b=2.0), 0)
    table.upsert_changed(kv(spark, a=1.0, b=2.5, c=0.0), 1)
    assert rows(table.history().filter("batch_id = 1").select("key", "value")) == [
        ("b", 2.5), ("c", 0.0)]


def test_increment_is_replay_safe(spark, table):
    table.upsert(kv(spark, a=0.1), 0)
    deltas = kv(spark, a=0.2, b=5.0).union(kv(spark, a=0.4))
    for _ in range(2):
        table.increment(deltas, 1)
    assert rows(table.current()) == [("a", 0.7), ("b", 5.0)]


def test_lookup_delete_and_reset(spark, table):
    table.upsert(kv(spark, a=1.0, b=2.0, c=3.0), 0)
    table.delete(keys(spark, "b", "b", "x"), 1)
    assert rows(table.lookup(keys(spark, "a", "b", "x"))) == [("a", 1.0), ("b", None), ("x", None)]
    table.reset(2)
    assert rows(table.current()) == [("a", 0.0), ("b", 0.0), ("c", 0.0), ("x", 0.0)]


def test_generations_start_from_the_values_before_them(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, span=2).create()
    for batch_id in range(5):
        table.increment(kv(spark, a=1.0, **{f"k{batch_id}": 1.0}), batch_id)
        if batch_id == 2:
            table = KeyedTable(spark, path, span=2)  # a restarted job
        table.increment(kv(spark, a=1.0, **{f"k{batch_id}": 1.0}), batch_id)
    want = [("a", 5.0)] + [(f"k{i}", 1.0) for i in range(5)]
    assert rows(table.current()) == want
    assert rows(KeyedTable(spark, path, span=2).current()) == want
    assert rows(table.current(upto=1)) == [("a", 2.0), ("k0", 1.0), ("k1", 1.0)]
    assert table.history().filter("batch_id < 3").count() == 0


def test_skipped_batch_numbers_and_deleted_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), span=2).create()
    table.upsert(kv(spark, a=1.0, b=2.0), 0)
    table.delete(keys(spark, "b"), 1)
    table.upsert_changed(kv(spark, a=1.0, c=3.0), 9)
    assert rows(table.current()) == [("a", 1.0), ("c", 3.0)]
    assert rows(table.history().filter("batch_id = 9").select("key")) == [("c",)]


def test_a_base_without_batches_is_not_trusted(spark, tmp_path):
    """The job was lost while it wrote the base: the next one writes it again."""
    table = KeyedTable(spark, str(tmp_path / "t"), span=2).create()
    table.upsert(kv(spark, a=1.0, b=2.0), 1)
    kv(spark, a=1.0).write.parquet(table._folder(1, 1))
    assert rows(table.current()) == [("a", 1.0), ("b", 2.0)]
    KeyedTable(spark, table.path, span=2).upsert(kv(spark, c=3.0), 2)
    assert rows(table.current()) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_create_leaves_an_existing_table_alone(spark, table):
    table.upsert(kv(spark, a=1.0), 0)
    assert rows(result_table(spark, table.path).current()) == [("a", 1.0)]


def test_composite_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "plat string, minute bigint").create()
    table.upsert(spark.createDataFrame([("tb", 60, 1.0)], "plat string, minute bigint, value double"), 0)
    assert rows(table.current()) == [("tb", 60, 1.0)]


def test_text_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("one",), ("two",)], "line string")
    messages.append_text(lines, str(tmp_path / "batch"))
    messages.append_text(lines, str(tmp_path / "batch"))
    assert rows(spark.read.text(str(tmp_path / "batch"))) == [("one",)] * 2 + [("two",)] * 2
    stream = spark.readStream.schema("value string").text(str(tmp_path / "batch"))
    messages.stream_text(stream, str(tmp_path / "out"), str(tmp_path / "k")).awaitTermination()
    assert spark.read.text(str(tmp_path / "out")).count() == 4


def test_work_dir_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_shuffles_start_with_enough_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        configure(spark, shuffle_bytes=10 * 2**30)
        assert spark.conf.get(name) == "80"
    finally:
        spark.conf.unset(name)


def test_reading_and_pruning_touch_only_the_newest_generation(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, span=2).create()
    for batch_id in range(7):
        table.increment(kv(spark, a=1.0), batch_id)
    newest = {f.split("generation=")[1].split("/")[0] for f in table.history().inputFiles()}
    assert newest == {"3"} and rows(table.current()) == [("a", 7.0)]
    table.prune(keep=1)
    assert table._numbers(path, "generation") == [3]
    assert rows(KeyedTable(spark, path, span=2).create().current()) == [("a", 7.0)]
    table.increment(kv(spark, a=1.0), 7)
    assert rows(table.current()) == [("a", 8.0)]


def test_reset_of_several_tables(spark, tmp_path):
    from tradetide.sinks.results import reset_all

    tables = [result_table(spark, str(tmp_path / name)) for name in ("turnover", "ratio")]
    for table in tables:
        table.upsert(kv(spark, a=2.0), 0)
    reset_all(tables, 1)
    assert [rows(t.current()) for t in tables] == [[("a", 0.0)]] * 2
