"""Compare a query with its SQL counterpart, order aside."""

from __future__ import annotations

import glob
import math
import os
import time
from collections import Counter

import duckdb

from pyspark.sql import SparkSession


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if hasattr(value, "asDict"):
        return tuple(value)
    return value


def difference(spark: SparkSession, con, fn, text: str | None, sf: str):
    """(rows, note): ``note`` is None when both sides agree."""
    df = fn(spark, sf)
    cols = sorted(df.columns)
    mine = Counter(tuple(plain(v) for v in row) for row in df.select(*cols).collect())
    n = sum(mine.values())
    if text is None:
        return n, None
    got = con.execute(text)
    names = [d[0] for d in got.description]
    if sorted(names) != cols:
        return n, f"columns {cols} but SQL gives {sorted(names)}"
    order = [names.index(c) for c in cols]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in got.fetchall())
    if mine == theirs:
        return n, None
    a, b = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
    return n, f"{n} rows, SQL {sum(theirs.values())}; {cols}\n    only here {a}\n    only SQL  {b}"


def check_all(spark: SparkSession, sf: str, names: list[str] = ()) -> list[str]:
    from . import ORACLES, QUERIES

    con = oracle_connection(sf)
    bad = []
    for name, fn in QUERIES.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            n, note = difference(spark, con, fn, ORACLES.get(name), sf)
        except Exception as error:  # noqa: BLE001 - reported, and counted as bad
            n, note = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "rows" if name not in ORACLES else "ok" if note is None else "BAD"
        if note is not None:
            bad.append(name)
        print(f"{kind:5}{name:38}{n:8} rows {time.time() - start:6.2f}s {note or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return bad
