"""Every query with an oracle: Spark result == DuckDB result on sf0.001
(column names, row count, multiset of rows with doubles rounded)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES, table_path
from tools.oracle_check import rows_of

from conftest import SMALL

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return c


def test_every_query_is_registered_with_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    own = [q for q in QUERIES if q != "pipeline" and not (q.startswith("op") and q[2].isdigit())]
    assert len(own) == 141


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SMALL)
    a, ac = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(ORACLE[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b
