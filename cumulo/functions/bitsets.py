"""Activity of many days as a fixed-width bitset: ``array<bigint>`` of 64-bit words.

Age 0 (today) is the highest bit of word 0, age 63 its lowest, age 64 the
highest of word 1.  The upper half of word 0 is thus the 32-day datelist int.
Everything is an expression on the row's own array.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col

WORD = 64


def words_for(days: int) -> int:
    if days < 1:
        raise ValueError("a bitset holds one day at least")
    return -(-days // WORD)


def _long(value: int) -> Column:
    """A 64-bit pattern as bigint literal (two's complement)."""
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("bigint")


def mask(word: int, days: int, first: int = 0) -> Column:
    """The bits of ages ``first .. days - 1`` that lie in a word."""
    ages = range(max(first, word * WORD), min(days, (word + 1) * WORD))
    return _long(sum(1 << (WORD - 1 - age % WORD) for age in ages))


def day_word(age, word: int) -> Column:
    """The bit of an age within a word; 0 where it lies in another."""
    a = as_col(age)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(WORD - 1) - F.pmod(a, F.lit(WORD))).cast("int"))
    return F.when((a >= word * WORD) & (a < (word + 1) * WORD), bit).otherwise(F.lit(0).cast("bigint"))


def empty(days: int) -> Column:
    return F.array(*[_long(0)] * words_for(days))


def shift(bits, by: int, days: int) -> Column:
    """The bitset ``by`` days later: every age grows, ages from ``days`` on are dropped."""
    if by < 0:
        raise ValueError("a bitset moves forward in time only")
    b = as_col(bits)
    jump, rest = divmod(by, WORD)

    def word(i: int) -> Column:
        return F.coalesce(F.get(b, i), _long(0)) if i >= 0 else _long(0)

    out = []
    for k in range(words_for(days)):
        moved = word(k - jump)
        if rest:
            moved = F.shiftrightunsigned(moved, rest).bitwiseOR(F.shiftleft(word(k - jump - 1), WORD - rest))
        out.append(moved.bitwiseAND(mask(k, days)))
    return F.array(*out)


def union(left, right) -> Column:
    """Days of either bitset; a missing one counts as empty."""
    return F.zip_with(F.coalesce(as_col(left), F.array().cast("array<bigint>")), F.coalesce(as_col(right), F.array().cast("array<bigint>")),
                      lambda x, y: F.coalesce(x, F.lit(0).cast("bigint")).bitwiseOR(F.coalesce(y, F.lit(0).cast("bigint"))))


def with_age(bits, age, days: int) -> Column:
    """``bits`` with the day of an age set; ages outside the window change nothing."""
    b, a = as_col(bits), as_col(age)
    return F.array(*[F.coalesce(F.get(b, k), _long(0)).bitwiseOR(F.coalesce(day_word(a, k), _long(0)).bitwiseAND(mask(k, days)))
                     for k in range(words_for(days))])


def count_days(bits, days: int, first: int = 0) -> Column:
    """Active days of ages ``first .. days - 1``."""
    b = as_col(bits)
    parts = [F.bit_count(F.coalesce(F.get(b, k), _long(0)).bitwiseAND(mask(k, days, first)))
             for k in range(first // WORD, words_for(days))]
    return reduce(lambda x, y: x + y, parts)


def recent32(bits) -> Column:
    """The datelist int of the last 32 days."""
    return F.shiftrightunsigned(F.coalesce(F.get(as_col(bits), 0), _long(0)), 32)


def is_idle(bits) -> Column:
    return F.forall(as_col(bits), lambda w: w == 0)
