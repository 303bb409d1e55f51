"""Queries whose whole result SQL can express, against DuckDB."""

from pathlib import Path

import pytest

from tidemark.llm.queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    df = QUERIES[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(names)
    rows = df.select(*names).collect()
    assert rows and sorted(map(tuple, rows), key=repr) == sorted(want.fetchall(), key=repr)
