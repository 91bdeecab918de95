"""Spark's rows against SQL's, with columns by name and rows in any order."""

from pathlib import Path

DATA = Path("/root/testdata/sf0.001")


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: str(round(v, 6)) if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def check(spark, name, query, sql):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    df = query(spark, str(DATA))
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns), name
    assert _rows(df.collect(), df.columns) == _rows(want.fetchall(), want.columns), name
