"""32-day activity bitsets ("datelist ints").

A list of active dates becomes one integer: the day ``as_of - age`` sets
bit ``top_bit - age``.  With the default ``top_bit=31`` today is the
highest of 32 bits and 32 days fit.  ``top_bit=32`` reproduces the
reference query, whose exponent ``32 - age`` puts today on bit 32; the
result is then cut to 32 bits, so today's activity is lost (SURVEY §8-Q1).

Everything is a higher-order expression on the row's own array, so no
cross join with a date series and no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col, as_date

# Fixed values (the reference's bit masks, written as 32-character strings):
#   weekly mask: 11111110000000000000000000000000  (7 most recent bit positions)
#   daily mask:  10000000000000000000000000000000  (most recent bit position)
WEEKLY_MASK_TEXT = "11111110000000000000000000000000"
DAILY_MASK_TEXT = "10000000000000000000000000000000"
WEEKLY_MASK = int(WEEKLY_MASK_TEXT, 2)
DAILY_MASK = int(DAILY_MASK_TEXT, 2)
LOW32 = (1 << 32) - 1


def datelist_bits(dates, as_of, days: int = 32, top_bit: int = 31) -> Column:
    """Bitset (bigint, low 32 bits) of the dates in ``[as_of-days+1, as_of]``.

    Duplicate dates are harmless (bits are OR-ed, not summed).
    """
    if not 0 <= top_bit <= 62:
        raise ValueError("top_bit must be within 0..62")
    arr = as_col(dates)
    ref = as_date(as_of)

    def age(d):
        return F.datediff(ref, d)

    kept = F.filter(arr, lambda d: (age(d) >= 0) & (age(d) < days) & (age(d) <= top_bit))
    bits = F.aggregate(
        kept,
        F.lit(0).cast("bigint"),
        lambda acc, d: acc.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(top_bit) - age(d))),
    )
    return bits.bitwiseAND(F.lit(LOW32).cast("bigint"))


def bits_text(bits) -> Column:
    """32-character binary text of a datelist int (like ``cast(x as bit(32))``)."""
    return F.lpad(F.bin(as_col(bits)), 32, "0")


def bit_count(bits) -> Column:
    return F.bit_count(as_col(bits))


def is_monthly_active(bits) -> Column:
    return F.bit_count(as_col(bits)) > 0


def is_weekly_active(bits) -> Column:
    return F.bit_count(as_col(bits).bitwiseAND(F.lit(WEEKLY_MASK).cast("bigint"))) > 0


def is_daily_active(bits) -> Column:
    return F.bit_count(as_col(bits).bitwiseAND(F.lit(DAILY_MASK).cast("bigint"))) > 0
