"""Property-graph vertices (J13): one vertex per id with a property map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.maps import string_map
from cumulo.operators.quality import dedup


def vertices(df: DataFrame, id_col: str, vertex_type: str, props: dict, order_by=None,
             id_alias: str = "identifier") -> DataFrame:
    """(identifier, type, properties map<string,string>), one row per id.

    ``props`` maps property name -> source column; values are cast to
    string.  The surviving row per id comes from ``order_by`` (default: all
    columns ascending), never from input order (SURVEY §8-Q8).
    """
    kept = dedup(df, [id_col], order_by)
    return kept.select(F.col(id_col).alias(id_alias), F.lit(vertex_type).alias("type"),
                       string_map(props).alias("properties"))


# The reference's team vertex properties (property -> column).
TEAM_PROPERTIES = {"abbreviation": "abbreviation", "nickname": "nickname", "city": "city",
                   "arena": "arena", "year_founded": "yearfounded"}


def team_vertices(teams: DataFrame, order_by=None) -> DataFrame:
    """The reference's team vertex job on its own schema."""
    return vertices(teams, "team_id", "team", TEAM_PROPERTIES, order_by)
