"""Rows of a Spark query beside those of its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tables(sf_dir: str = SMALL):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def both(df, sql: str, sf_dir: str = SMALL):
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = tables(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    return ours, theirs
