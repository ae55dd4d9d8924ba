"""Fact-table jobs: load with dedup (J2), enrich (J3), conditional rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.text import minutes_from_text, token_flag
from cumulo.functions.util import as_col, names
from cumulo.operators.joins import maybe_broadcast
from cumulo.operators.quality import dedup


def build_fact(details: DataFrame, parents: DataFrame, detail_key, parent_key,
               grain, columns: dict, order_by=None) -> DataFrame:
    """Join detail rows to their parent for context, keep one row per
    ``grain`` and project the fact columns (J2).

    ``columns`` maps output names to Columns over both inputs.  ``order_by``
    picks the surviving duplicate (default: every detail column, a total
    order).  When the join key is part of the grain, parent columns are
    constant inside a duplicate group, so the dedup runs *before* the join:
    the join then reads the reduced detail side, and a hot parent key can
    be split by AQE's skew-join handling (it could not be if a window
    followed the join on the same partitioning).
    """
    dk, pk, g = names(detail_key), names(parent_key), names(grain)
    cond = [details[a] == parents[b] for a, b in zip(dk, pk)]
    if set(dk) <= set(g):
        kept = dedup(details, g, order_by)
        joined = kept.join(parents, cond, "inner")
    else:
        # grain and default order name their side explicitly (detail side
        # first), so a column name shared with the parent stays unambiguous
        def side(c):
            return details[c] if c in details.columns else parents[c]

        order = ([as_col(c) for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
                 if order_by is not None
                 else [details[c].asc_nulls_first() for c in details.columns if c not in g]
                 + [parents[c].asc_nulls_first() for c in parents.columns if c not in g])
        w = Window.partitionBy(*[side(c) for c in g]).orderBy(*order)
        joined = (details.join(parents, cond, "inner")
                         .withColumn("_cumulo_rn", F.row_number().over(w))
                         .where(F.col("_cumulo_rn") == 1))
    return joined.select(*[as_col(c).alias(n) for n, c in columns.items()])


# Reference fact layout for game details (measure name -> source column).
GAME_MEASURES = {
    "m_fgm": "fgm", "m_fga": "fga", "m_fg3m": "fg3m", "m_fg3a": "fg3a",
    "m_ftm": "ftm", "m_fta": "fta", "m_oreb": "oreb", "m_dreb": "dreb",
    "m_reb": "reb", "m_ast": "ast", "m_stl": "stl", "m_blk": "blk",
    "m_turnovers": "TO", "m_pf": "pf", "m_pts": "pts", "m_plus_minus": "plus_minus",
}
# Comment tokens -> flag columns.
GAME_FLAGS = {"dim_not_play": "DNP", "dim_not_dress": "DND", "dim_not_with_team": "NWT"}


def game_fact(game_details: DataFrame, games: DataFrame, order_by=None) -> DataFrame:
    """The reference's ``fact_game_details`` load on its own schemas.

    Grain (game_id, team_id, player_id), all three in the result; ``dim_is_playing_at_home`` stays
    NULL when either team id is NULL; minutes parsed from ``mm:ss`` text.
    """
    d, g = game_details.alias("gd"), games.alias("g")
    cols: dict[str, Column] = {
        "game_id": F.col("gd.game_id"),
        "dim_game_date": F.col("g.game_date_est").cast("date"),
        "dim_season": F.col("g.season"),
        "dim_team_id": F.col("gd.team_id"),
        "dim_player_id": F.col("gd.player_id"),
        "dim_player_name": F.col("gd.player_name"),
        "dim_start_position": F.col("gd.start_position"),
        "dim_is_playing_at_home": F.col("gd.team_id") == F.col("g.home_team_id"),
    }
    for name, token in GAME_FLAGS.items():
        cols[name] = token_flag(F.col("gd.comment"), token)
    cols["m_minutes"] = minutes_from_text(F.col("gd.min"))
    for name, src in GAME_MEASURES.items():
        cols[name] = F.col(f"gd.`{src}`")
    return build_fact(d, g, "game_id", "game_id", ["game_id", "team_id", "player_id"], cols, order_by)


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           max_broadcast_bytes: int | None = None) -> DataFrame:
    """Fact rows with the attributes of their dimension row.

    The dimension is broadcast only when its estimated size is small;
    otherwise this is a shuffle join on the key.
    """
    d = maybe_broadcast(dim, max_broadcast_bytes)
    return fact.join(d, fact[fact_key] == d[dim_key], "inner")


def conditional_rate(df: DataFrame, key, flag, total_col: str = "num_rows",
                     hit_col: str = "num_flagged", rate_col: str = "flag_rate") -> DataFrame:
    """Per key: rows, rows where ``flag`` holds, and their share (J4),
    highest share first (ties by key)."""
    ks = names(key)
    f = as_col(flag)
    return (df.groupBy(*ks)
              .agg(F.count(F.lit(1)).alias(total_col),
                   F.count_if(f).alias(hit_col))
              .withColumn(rate_col, F.col(hit_col).cast("double") / F.col(total_col))
              .orderBy(F.col(rate_col).desc(), *[F.col(k).asc() for k in ks]))
