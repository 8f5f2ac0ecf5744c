from tradetide.functions.money import exact_sum, to_money
from tradetide.functions.scalar import (
    concat_world,
    minute_bucket,
    parse_number,
    pay_source_name,
    result_key,
    round_cents,
    round_half_even,
    round_half_up,
    terminal_name,
    trade_platform,
)

__all__ = [
    "concat_world",
    "exact_sum",
    "minute_bucket",
    "parse_number",
    "pay_source_name",
    "result_key",
    "round_cents",
    "round_half_even",
    "round_half_up",
    "terminal_name",
    "to_money",
    "trade_platform",
]
