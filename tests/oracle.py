"""Compares a query with its SQL in DuckDB over the same tables."""

import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings contig_types hic_links paf self_paf depth_win read_placement eval_items mix_targets".split()


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def check(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    df = query(spark, sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = Counter(tuple(_plain(v) for v in r) for r in cur.fetchall())
    got = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
