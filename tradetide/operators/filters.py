"""Row filters; each has a counterpart that keeps what it rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide import schemas as S
from tradetide.functions import terminal_name


def of_type(tagged: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind (``pay`` or ``order``) of a tagged union."""
    return tagged.filter(F.col("type") == kind)


def valid_terminals(payments: DataFrame) -> DataFrame:
    """Payments from a known terminal, with the terminal's name."""
    known = payments.filter(F.col("pay_platform").isin(S.TERMINAL_PC, S.TERMINAL_MOBILE))
    return known.withColumn("terminal", terminal_name("pay_platform"))


def invalid_terminals(payments: DataFrame) -> DataFrame:
    """Payments whose terminal code is missing or unknown."""
    known = F.col("pay_platform").isin(S.TERMINAL_PC, S.TERMINAL_MOBILE)
    return payments.filter(~F.coalesce(known, F.lit(False)))


def positive_amounts(payments: DataFrame) -> DataFrame:
    """Payments that may be published: zero amounts are left out."""
    return payments.filter("pay_amount > 0")


def amount_check(payments: DataFrame) -> DataFrame:
    """One row: publishable, zero and (invalid) negative payments."""
    return payments.agg(
        F.count_if(F.col("pay_amount") > 0).alias("published"),
        F.count_if(F.col("pay_amount") == 0).alias("zero"),
        F.count_if(F.col("pay_amount") < 0).alias("negative"),
    )
