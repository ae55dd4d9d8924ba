"""Every registered query against its oracle on edge-value copies of the
smallest tables (NULL keys and values, fractional quantities, missing JSON
fields), where Spark and DuckDB defaults (NULL order, cast rounding) differ."""

import duckdb
import pytest

import __spark_entry__ as E
from cumulo.sources.session import work_path
from cumulo.sources.tables import TABLES
from scripts.check_oracle import SPARK_TO_DUCK, canon
from scripts.make_edge_tables import write_edge_tables

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def edge(spark):
    out = write_edge_tables(spark, work_path(spark, "edge_tables"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    yield out, con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_on_edge_values(spark, edge, name):
    sf_dir, con = edge
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = dict(zip(ocols, [str(t) for t in con.sql(ORACLE[name]).types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == otypes[f.name], f.name
    assert canon(df.columns, srows) == canon(ocols, orows)
