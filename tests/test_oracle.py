"""Every query with SQL against DuckDB on the smallest driver tables."""

import datetime
from pathlib import Path

import pytest

from tidemark.queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no driver tables")


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda v: round(v, 5) if isinstance(v, float) else v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    want = want.fetchall()
    df = QUERIES[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(names)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want, names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() > 0
