import pytest
from helpers import rows
from pyspark.sql import functions as F

from tradetide import functions as fn


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


def values(spark, data, ddl, column):
    frame = spark.createDataFrame([(x,) for x in data], ddl)
    return [r[0] for r in frame.select(column).collect()]


def test_minute_starts_at_sixty_seconds(spark):
    assert values(spark, [0, 59_999, 60_000, 1_704_067_259_999], "t bigint", fn.minute_bucket("t")) == [
        0, 0, 60, 1_704_067_200]


def test_round_cents_breaks_ties_upward_on_the_binary_value(spark):
    data = [1.005, -1.005, 0.125, -0.125, 2.5, -0.001]
    assert values(spark, data, "x double", fn.round_cents("x")) == [1.0, -1.0, 0.13, -0.12, 2.5, 0.0]


def test_round_half_even(spark):
    data = [0.125, 0.375, -0.125, 1.0]
    assert values(spark, data, "x double", fn.round_half_even("x")) == [0.12, 0.38, -0.12, 1.0]


def test_round_rejects_negative_places(spark):
    with pytest.raises(ValueError):
        fn.round_half_up("x", -1)


def test_terminal_and_platform_names(spark):
    assert values(spark, [0, 1, 9, None], "x smallint", fn.terminal_name("x")) == [
        "pc", "mobile", None, None]
    assert values(spark, ["tb_order", "tm_order", "other"], "x string", fn.trade_platform("x")) == [
        "tb", "tm", "tm"]


def test_pay_source_names(spark):
    assert values(spark, [0, 1, 2, 3, 7], "x smallint", fn.pay_source_name("x")) == [
        "wallet", "coupon", "bank_card", "other", None]


def test_result_key_and_concat(spark):
    assert values(spark, [60], "m bigint", fn.result_key("ratio_", "m")) == ["ratio_60"]
    assert values(spark, ["Hello"], "m string", fn.concat_world("m")) == ["HelloWorld"]


def test_parse_number_gives_null_for_text(spark):
    assert values(spark, ["1.5", "x", "", None], "v string", fn.parse_number("v")) == [
        1.5, None, None, None]


def test_exact_sum_does_not_depend_on_order(spark):
    cents = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.6] * 2000
    frame = spark.createDataFrame([(x,) for x in cents], "x double").repartition(8)
    total = frame.agg(fn.exact_sum("x").cast("double").alias("s")).first()["s"]
    assert total == 2_000_000_020.0


def test_exact_sum_of_nothing_is_null(spark):
    assert rows(spark.createDataFrame([], "x double").agg(fn.exact_sum("x"))) == [(None,)]


def test_exact_sum_beyond_what_cents_in_a_long_could_hold(spark):
    frame = spark.range(1000).select(F.lit(9.0e14).alias("x"))
    assert int(frame.agg(fn.exact_sum("x")).first()[0]) == 900_000_000_000_000_000
