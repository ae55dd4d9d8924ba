"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from cumulo.functions.arrays import join_text, pad_to, slot_counts, slotwise_sum, splice_slot, zeros
from cumulo.functions.bits import (bit_count, bits_text, datelist_bits, is_daily_active,
                                   is_monthly_active, is_weekly_active)
from cumulo.functions.dates import day, day_slot, month_start
from cumulo.functions.maps import map_text, string_map
from cumulo.functions.text import minutes_from_text, token_flag

__all__ = [
    "join_text", "pad_to", "slot_counts", "slotwise_sum", "splice_slot", "zeros",
    "bit_count", "bits_text", "datelist_bits", "is_daily_active", "is_monthly_active",
    "is_weekly_active", "day", "day_slot", "month_start", "map_text", "string_map",
    "minutes_from_text", "token_flag",
]
