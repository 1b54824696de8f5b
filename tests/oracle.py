"""Runs a query and its SQL twin and compares rows as the driver does: columns by name, rows in any order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(v):
    return "NULL" if v is None else str(int(v)) if isinstance(v, bool) else f"{v:.6g}" if isinstance(v, float) else str(v)


def compare(spark, sf, query, sql):
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(text(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want
