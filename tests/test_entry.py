"""The registered queries against their SQL, over the smallest tables."""

import math
from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else str(v)[:10] if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, str(DATA))
    names = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    sql = db.sql(entry.oracle_sql()[name])
    assert sorted(sql.columns) == names
    at = [list(sql.columns).index(c) for c in names]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in sql.fetchall()), key=repr)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
