"""Column expressions; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradetide import schemas as S


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def minute_bucket(millis: Column | str) -> Column:
    """Epoch milliseconds to the epoch second at which its minute starts."""
    return F.call_function("div", _col(millis), F.lit(60_000)) * S.MINUTE


def trade_platform(topic: Column | str) -> Column:
    """Order topic to platform; whatever is not ``tb_order`` counts as ``tm``."""
    return F.when(_col(topic) == S.TOPIC_TB_ORDER, S.PLAT_TB).otherwise(S.PLAT_TM)


def terminal_name(code: Column | str) -> Column:
    """Terminal code to ``pc`` / ``mobile``; null for an invalid code."""
    code = _col(code)
    return F.when(code == S.TERMINAL_PC, "pc").when(code == S.TERMINAL_MOBILE, "mobile")


def pay_source_name(code: Column | str) -> Column:
    """Payment source code to its name; null for an unknown code."""
    names = F.create_map(
        *[F.lit(x) for code_, name in S.PAY_SOURCES.items() for x in (code_, name)]
    )
    return F.try_element_at(names, _col(code).cast("int"))


def round_half_up(value: Column | str, places: int) -> Column:
    """Round on the binary value, ties toward positive infinity.

    ``F.round`` works on the decimal text and rounds ties away from zero, so it
    turns 1.005 into 1.01 and -1.005 into -1.01 where this gives 1.0 and -1.0.
    """
    if places < 0:
        raise ValueError("places must not be negative")
    factor = float(10**places)
    return F.floor(_col(value) * factor + 0.5).cast("double") / factor


def round_cents(value: Column | str) -> Column:
    return round_half_up(value, 2)


def round_half_even(value: Column | str) -> Column:
    """Round to cents on the binary value, ties to the even cent."""
    return F.rint(_col(value) * 100.0) / 100.0


def result_key(prefix: str | Column, minute: Column | str) -> Column:
    """Key under which a minute is published."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, _col(minute).cast("string"))


def parse_number(text: Column | str) -> Column:
    """Text to double; null, not an error, where it is no number."""
    return _col(text).try_cast("double")


def concat_world(message: Column | str) -> Column:
    return F.concat(_col(message), F.lit("World"))
