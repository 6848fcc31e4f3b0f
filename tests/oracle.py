"""Run a registered query in Spark and in DuckDB and compare rows, names and values."""

from __future__ import annotations

import math
import time

import duckdb

from draftlake.registry import ORACLES, QUERIES
from draftlake.sources.tables import STAR_TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v) if not isinstance(v, bool) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str):
    """(problem or None, row count, seconds in Spark, seconds in DuckDB)."""
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    if name not in ORACLES:
        return (None if got else "no rows"), len(got), t1 - t0, 0.0
    cur = con.execute(ORACLES[name])
    exp = cur.fetchall()
    t2 = time.time()
    gn, gr = rows_of(df.columns, [tuple(r) for r in got])
    en, er = rows_of([c[0] for c in cur.description], exp)
    problem = None
    if gn != en:
        problem = f"columns {gn} != {en}"
    elif len(gr) != len(er):
        problem = f"rows {len(gr)} != {len(er)}"
    elif gr != er:
        bad = [(a, b) for a, b in zip(gr, er) if a != b]
        problem = f"{len(bad)} differing rows, columns {gn}, first {bad[0]}"
    return problem, len(got), t1 - t0, t2 - t1
