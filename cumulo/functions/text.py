"""Text helpers used when a fact is loaded from loosely typed text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col


def token_flag(text, token: str) -> Column:
    """True when ``token`` occurs in ``text``; a NULL text gives False.

    Same truth table as ``coalesce(position(token in text), 0) > 0``.
    """
    return F.coalesce(as_col(text).contains(token), F.lit(False))


def minutes_from_text(text, sep: str = ":") -> Column:
    """Decimal minutes from ``"mm:ss"`` text.

    ``'12:30'`` -> 12.5, ``'12'`` -> 12.0 (a missing seconds part counts as
    zero), ``''``, ``NULL`` or a non-numeric minutes part -> NULL.  Uses
    ``try_cast`` so a bad row never fails the load (ANSI casts raise).
    """
    t = as_col(text)
    mins = F.split_part(t, F.lit(sep), F.lit(1)).try_cast("double")
    sec_txt = F.split_part(t, F.lit(sep), F.lit(2))
    secs = F.when(sec_txt == "", F.lit(0.0)).otherwise(sec_txt.try_cast("double"))
    return mins + secs / F.lit(60.0)
