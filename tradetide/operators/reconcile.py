"""Comparing published results with independently computed expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.functions import exact_sum


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every expected key with what was published and how far that is off.

    A missing key is off by its whole expected value.
    """
    return (
        expected.select("key", "expected")
        .join(actual.select("key", F.col("value").alias("actual")), "key", "left")
        .withColumn(
            "abs_error",
            F.when(F.col("actual").isNull(), F.col("expected"))
            .otherwise(F.abs(F.col("actual") - F.col("expected"))),
        )
    )


def reconcile_totals(compared: DataFrame) -> DataFrame:
    """One row over ``reconcile``: keys, missing keys, sums of value and error."""
    return compared.agg(
        F.count("*").alias("keys"),
        F.count_if(F.col("actual").isNull()).alias("missing"),
        F.coalesce(exact_sum("expected").cast("double"), F.lit(0.0)).alias("total_expected"),
        F.coalesce(exact_sum("abs_error").cast("double"), F.lit(0.0)).alias("total_error"),
    )


def reconcile_ratio(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: ratio keys present and missing, and the largest difference."""
    compared = reconcile(expected, actual)
    found = F.col("actual").isNotNull()
    return compared.agg(
        F.count("*").alias("keys"),
        F.count_if(found).alias("present"),
        F.count_if(~found).alias("missing"),
        F.max(F.when(found, F.col("abs_error"))).alias("max_error"),
    )
