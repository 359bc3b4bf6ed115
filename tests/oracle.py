"""Compare a query's rows with those that DuckDB gives for its SQL."""

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def normal(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    if isinstance(v, (list, tuple)):
        return [normal(x) for x in v]
    return str(v)


def rows_of_sql(sql: str, sf: str = SF):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    r = c.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted([normal(row[i]) for i in order] for row in r.fetchall())


def rows_of_df(df):
    names = sorted(df.columns)
    return names, sorted([normal(r[c]) for c in names] for r in df.collect())
