"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from cumulo.sources.tables import TABLES
from scripts.check_oracle import SPARK_TO_DUCK, canon
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "dim_order_date"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(srows) > 0
        return
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = dict(zip(ocols, [str(t) for t in duck.sql(ORACLE[name]).types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == otypes[f.name], f.name
    assert canon(df.columns, srows) == canon(ocols, orows)
