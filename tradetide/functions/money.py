"""Sums of money that do not depend on the order of the rows.

Amounts are doubles.  Adding doubles in whatever order tasks finish gives a
slightly different total on every run, and casting each row to a decimal costs
more than the scan.  ``exact_sum`` adds whole units and millionths as two
64-bit integers instead, and joins them once per group.  Neither can overflow
below 9e12 rows of up to a million units each; beyond, ANSI mode raises.  An
amount of ``LIMIT`` or more, or one that is no number, raises too: nothing saturates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(27,6)"  # one amount, or the total of a minute or an order
TOTAL = "decimal(37,6)"  # a running total of those
LIMIT = 1e15  # above, a double no longer holds hundredths


def money_parts(amount: Column | str) -> tuple[Column, Column]:
    """An amount as whole units and millionths, both integers."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    outside = amount.isNotNull() & ~(F.abs(amount) < LIMIT)
    whole = F.when(
        outside, F.raise_error(F.lit("amount out of range")).cast("bigint")
    ).otherwise(F.floor(amount))
    return whole, F.floor((amount - whole) * 1_000_000 + 0.5)


def money_of(whole: Column, millionths: Column) -> Column:
    """Units and millionths, or sums of them, as exact money."""
    rest = millionths.cast("decimal(19,0)") * F.lit(Decimal("0.000001"))
    return (whole.cast("decimal(25,6)") + rest).cast(MONEY)


def exact_sum(amount: Column | str) -> Column:
    """Sum of a double column as exact money; null over no values."""
    whole, millionths = money_parts(amount)
    return money_of(F.sum(whole), F.sum(millionths))


def to_money(amount: Column | str) -> Column:
    """One double as exact money, to the millionth."""
    return money_of(*money_parts(amount))
