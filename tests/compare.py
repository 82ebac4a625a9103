"""Runs queries beside their SQL on the same tables, as the driver does: row count, column names and values, in any order."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(spark, sf_dir: str, name: str, f, sql: str) -> str:
    """Empty where both are equal, else what differs."""
    df = f(spark, sf_dir)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    r = con.execute(sql)
    names = [x[0] for x in r.description]
    kinds = {n: str(x[1]) for n, x in zip(names, r.description)}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    a = sorted((tuple(plain(row[c]) for c in order) for row in df.collect()), key=repr)
    b = sorted((tuple(plain(row[names.index(c)]) for c in order) for row in r.fetchall()), key=repr)
    if a == b:
        return ""
    sa, sb = set(a), set(b)
    return f"{len(a)} and {len(b)} rows; only here {sorted(sa - sb, key=repr)[:3]}; only in SQL {sorted(sb - sa, key=repr)[:3]} {kinds}"


if __name__ == "__main__":
    import time

    import __spark_entry__ as e
    from fieldloom.runtime import session

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    sql = e.oracle_sql()
    for name, f in e.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            if name in sql:
                out = compare(spark, sf, name, f, sql[name]) or "same"
            else:
                out = f"{f(spark, sf).count()} rows, no SQL"
        except Exception as x:  # noqa: BLE001
            out = f"{type(x).__name__}: {str(x)[:600]}"
        print(f"{name}: {out[:900]} ({time.time() - t:.1f} s)", flush=True)
