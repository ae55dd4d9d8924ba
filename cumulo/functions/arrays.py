"""Array expressions for reduced (one slot per day) facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col


def zeros(n) -> Column:
    """``array_fill(0, n)``: n zero slots; n = 0 gives ``[]``.  Combined with
    an array of another numeric type they take that type."""
    n = F.lit(n) if isinstance(n, int) else as_col(n)
    return F.array_repeat(F.lit(0), n)


def splice_slot(arr, slot, value) -> Column:
    """Write ``value`` into 1-based ``slot`` of ``arr``.

    Shorter arrays are zero-padded up to ``slot - 1``; slots after ``slot``
    are kept.  A rerun of the same day therefore rewrites the slot instead
    of appending another one (SURVEY §8-Q4), and loading an earlier day
    after a later one leaves the later slots in place.  A NULL ``arr`` is
    an empty history.  The result holds the wider of the array's and the
    value's types, so fractions stay.
    """
    a = F.coalesce(as_col(arr), F.array())
    s = F.lit(slot) if isinstance(slot, int) else as_col(slot)
    v = as_col(value) if isinstance(value, (str, Column)) else F.lit(value)
    head = F.slice(F.concat(a, zeros(s)), F.lit(1), s - 1)
    tail = F.when(F.size(a) > s, F.slice(a, s + 1, F.size(a) - s)).otherwise(F.array())
    return F.concat(head, F.array(v), tail)


def pad_to(arr, n) -> Column:
    """Right-pad ``arr`` with zeros to length ``n`` (longer arrays unchanged)."""
    a = F.coalesce(as_col(arr), F.array())
    n = F.lit(n) if isinstance(n, int) else as_col(n)
    return F.concat(a, zeros(F.greatest(n - F.size(a), F.lit(0))))


def slot_counts(slot, n_slots: int, value=None) -> Column:
    """Aggregate: per-slot sums in one fixed-width array.

    ``slot`` is the 0-based slot of each input row; the result has
    ``n_slots`` entries, entry i = sum of ``value`` (or row count) over rows
    in slot i, in the type a ``sum`` of the value has.  Each entry is an
    ordinary ``sum``, so the aggregate runs as a hash aggregate with map-side
    partial aggregation: one shuffle, bounded state, no list collected per
    key.
    """
    s = as_col(slot)
    v = F.lit(1).cast("bigint") if value is None else as_col(value)
    return F.array(*[F.coalesce(F.sum(F.when(s == i, v)), F.lit(0)) for i in range(n_slots)])


def slotwise_sum(arr, n_slots: int) -> Column:
    """Aggregate: element-wise sum of the first ``n_slots`` entries of arrays
    (missing slots count as 0)."""
    a = as_col(arr)
    return F.array(*[F.coalesce(F.sum(F.get(a, i)), F.lit(0)) for i in range(n_slots)])


def join_text(arr, sep: str = ",") -> Column:
    """Array -> text (elements cast to string), for hashing and display."""
    return F.array_join(F.transform(as_col(arr), lambda x: x.cast("string")), sep)
