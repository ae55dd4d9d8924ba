"""Rolling activity state (J5-J8, J28): a bitset per key instead of a list of
dates that grows for ever.

The state of a day is yesterday's, moved by one day, with today's keys set: one
full outer join per day, on which a bucketed store needs no shuffle of the
state.  A key without a day in the window leaves the state, so its size follows
the keys active within the window, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions import bitsets
from cumulo.functions.bits import bits_text, is_daily_active, is_monthly_active, is_weekly_active
from cumulo.functions.dates import day
from cumulo.functions.util import as_date, to_pydate
from cumulo.operators.cumulative import _day_events, _split_null_key

#: Days that the state holds.
DAYS = 365


def rebuild_bits(events: DataFrame, key: str, ts: str, as_of, days: int = DAYS, drop_null_keys: bool = True,
                 bits_col: str = "activity", snapshot_col: str = "snapshot_date") -> DataFrame:
    """Closed form: (key, bits_col, snapshot_col) of the keys active in the last
    ``days`` days.  One aggregate with a fixed number of words as its state."""
    import datetime as dt

    end = to_pydate(as_of)
    ev = _day_events(events, ts, end - dt.timedelta(days=days - 1), end)
    if drop_null_keys:
        ev = ev.where(F.col(key).isNotNull())
    age = F.datediff(as_date(end), day(ts))
    words = [F.bit_or(bitsets.day_word(age, k)).alias(f"_w{k}") for k in range(bitsets.words_for(days))]
    return (ev.groupBy(key).agg(*words)
              .select(key, F.array(*[f"_w{k}" for k in range(len(words))]).alias(bits_col), as_date(end).alias(snapshot_col)))


def roll_bits(prev: DataFrame, today: DataFrame, key: str, as_of, days: int = DAYS, bits_col: str = "activity",
              snapshot_col: str = "snapshot_date", null_safe_key: bool = False, gap: int = 1) -> DataFrame:
    """State of ``as_of`` from the state ``gap`` days before (other days of
    ``prev`` are not read) and the keys active on ``as_of`` (one row each)."""
    d = as_date(as_of)
    y = prev.where(F.col(snapshot_col) == F.date_sub(d, gap)).select(key, bits_col)
    t = today.select(key).withColumn("_active", F.lit(0))

    def merge(tt, yy, null_safe):
        tt, yy = tt.alias("t"), yy.alias("y")
        on = F.col(f"t.{key}").eqNullSafe(F.col(f"y.{key}")) if null_safe else F.col(f"t.{key}") == F.col(f"y.{key}")
        j = tt.join(yy, on, "full_outer")
        moved = bitsets.shift(F.coalesce(F.col(f"y.{bits_col}"), bitsets.empty(days)), gap, days)
        bits = bitsets.with_age(moved, F.col("t._active"), days)
        return j.select(F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key), bits.alias(bits_col), d.alias(snapshot_col))

    return _split_null_key(t, y, key, null_safe_key, merge).where(~bitsets.is_idle(bits_col))


def activity_report(snapshot: DataFrame, key: str, bits_col: str = "activity", spans=(7, 28, 365)) -> DataFrame:
    """Per key: the datelist int with its flags, and the active days of the last
    ``spans`` days."""
    out = snapshot.select(key, bits_col, bitsets.recent32(bits_col).alias("datelist_int"))
    return out.select(key, "datelist_int", bits_text("datelist_int").alias("datelist_bits"),
                      is_monthly_active("datelist_int").alias("dim_is_monthly_active"),
                      is_weekly_active("datelist_int").alias("dim_is_weekly_active"),
                      is_daily_active("datelist_int").alias("dim_is_daily_active"),
                      *[bitsets.count_days(bits_col, n).cast("bigint").alias(f"days_{n}") for n in spans])
