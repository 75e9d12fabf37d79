"""The registered queries run, and agree with their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from quern.plans.run_queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in ORACLE_SQL:
        want = sql.sql(ORACLE_SQL[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
