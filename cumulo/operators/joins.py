"""Join strategies: size-checked broadcast, joins with dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.plans.inspect import estimated_bytes, has_join, session_conf


def broadcast_limit(df: DataFrame, max_bytes: int | None = None) -> int:
    """``max_bytes``, else the session's auto-broadcast threshold in bytes
    (Spark parses values like ``"50MB"``); -1 there means that the session
    has switched broadcasting off, and nothing is hinted."""
    if max_bytes is not None:
        return max_bytes
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def parse_bytes(text) -> int:
    """Spark byte strings (``"10485760"``, ``"10MB"``, ``"1g"``, ``"-1"``) to bytes."""
    import re

    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def maybe_broadcast(small: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(small)`` only when Catalyst's size estimate of ``small``
    is within ``max_bytes`` (default: the session's auto-broadcast limit).
    The estimate is for base tables; a derived side is a product of estimates,
    so it is left to AQE, which broadcasts it at run time from real sizes."""
    if not has_join(small) and estimated_bytes(small) <= broadcast_limit(small, max_bytes):
        return F.broadcast(small)
    return small


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               strategy: str = "auto", max_bytes: int | None = None) -> DataFrame:
    """Join a fact with a small table.

    ``strategy``: ``"broadcast"`` or ``"auto"`` (size-checked hint),
    ``"shuffle"`` (sort-merge, forced with a ``merge`` hint), or ``"bloom"``
    (sort-merge whose big side is filtered in its scan, see ``bloom_join``).
    """
    if strategy == "shuffle":
        return big.join(small.hint("merge"), on, how)
    if strategy == "bloom":
        return bloom_join(big, small, on, how)
    if strategy not in ("auto", "broadcast"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return big.join(maybe_broadcast(small, max_bytes), on, how)


#: Spark's run-time filters whatever the sizes (by default the filtered scan has
#: to have 10 GB, and the other side to be a scan of 10 MB at most).
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtimeFilter.number.threshold": "10",
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # filters are for joins that shuffle
}


def bloom_join(big: DataFrame, small: DataFrame, on, how: str = "inner", expected_keys: int | None = None) -> DataFrame:
    """Join two sides too large to broadcast of which ``small`` is filtered: a
    Bloom filter of its keys (bounded bits) reaches ``big``'s scan, and rows
    without a partner are dropped before the shuffle.

    The plan is made here, under the settings for it.  ``expected_keys`` sizes
    the filter; Spark's own limit of bits holds, more keys mean more rows that
    pass for nothing, never a lost row.
    """
    if how not in ("inner", "left_semi", "right", "right_outer"):
        raise ValueError(f"rows of the big side can't be dropped in a {how!r} join")
    spark = big.sparkSession
    more = {}
    if expected_keys:
        more = {"spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": expected_keys,
                "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": max(expected_keys, 4_000_000)}
    with session_conf(spark, **BLOOM, **more):
        out = big.join(small.hint("merge"), on, how)
        out._jdf.queryExecution().executedPlan()  # kept with the DataFrame
    return out


def stage_map_medals(maps: DataFrame, matches: DataFrame, medals_players: DataFrame,
                     map_key: str = "mapid", match_key: str = "match_id") -> DataFrame:
    """Maps ⋈ matches ⋈ medals per player, the staging rows.

    ``maps`` is a small dimension (size-checked broadcast); matches and
    medal rows are both large and meet in one shuffle join on the match.
    Each medal row belongs to one match, so the output has one row per
    medal row with a known match and map: no fan-out.
    """
    mm = matches.join(maybe_broadcast(maps), map_key, "inner")
    return mm.join(medals_players, match_key, "inner")


def join_strategies(big: DataFrame, small: DataFrame, on, how: str = "inner") -> dict:
    """The physical join chosen for each strategy of ``join_small`` (plans
    only, nothing runs): ``{"broadcast": "BroadcastHashJoin", "shuffle":
    "SortMergeJoin", ...}`` - the explain() comparison of J20."""
    from cumulo.plans.inspect import plan_nodes

    out = {}
    for strategy in ("broadcast", "shuffle", "auto"):
        nodes = plan_nodes(join_small(big, small, on, how, strategy=strategy))
        out[strategy] = next((n for n in nodes if n.endswith("Join")), None)
    return out
