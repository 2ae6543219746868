"""Spark rows against DuckDB rows, without regard to order."""

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def same(df, sql, sf_dir):
    found = duck(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = Counter(tuple(r) for r in found.fetchall())
    got = Counter(tuple(r) for r in df.select(*names).collect())
    assert expected and got == expected
