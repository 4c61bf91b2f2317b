"""Side-by-side run of a query and its SQL: same rows, same columns, values equal."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(v: object) -> object:
    if isinstance(v, datetime.datetime) and v.tzinfo:
        return v.astimezone(datetime.UTC).replace(tzinfo=None)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, name: str, fn, sql: str | None, folder: str, con=None) -> str:
    """An empty text if both sides agree."""
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ""
    rel = (con or connect(folder)).sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"{name}: columns {got[0]} and {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{name}: {len(got[1])} rows, SQL has {len(want[1])}; e.g. only here {[x for x in got[1] if x not in want[1]][:2]}, only there {[x for x in want[1] if x not in got[1]][:2]}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{name}: {a} and {b}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as e
    from vestigo.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    fns, sql = e.queries(), e.oracle_sql()
    spark, con = build_session(8), connect(folder)
    for n in names or fns:
        t = time.time()
        try:
            said = compare(spark, n, fns[n], sql.get(n), folder, con)
        except Exception as x:  # noqa: BLE001
            said = f"{n}: {type(x).__name__} {str(x)[:1500]}"
        print(f"{n} {time.time() - t:.1f}s", said or ("ok" if n in sql else "ran"), flush=True)
