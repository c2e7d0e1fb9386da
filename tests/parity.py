"""Compare a query with its oracle: same columns, same rows in any order."""

import datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


def rows(table, columns):
    return sorted(repr(tuple(plain(r[c]) for c in columns)) for r in table.to_pylist())


def same(df, con, sql):
    left, right = df.toArrow(), con.sql(sql).to_arrow_table()
    columns = sorted(left.column_names)
    assert columns == sorted(right.column_names)
    a, b = rows(left, columns), rows(right, columns)
    assert a == b, [p for p in zip(a, b, strict=False) if p[0] != p[1]][:3]
    return len(a)
