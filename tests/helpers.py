import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(x):
    if x is None or x is pd.NA or x != x:
        return None
    return int(x) if isinstance(x, float) and x == int(x) else x


def rows(frame, cols):
    return sorted(repr([plain(x) for x in r]) for r in frame[cols].astype(object).itertuples(index=False))


def same_as_sql(df, sql, d=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    a, b = df.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert rows(a, cols) == rows(b, cols)
