"""Runs catalog queries in Spark and their SQL in DuckDB and compares the rows exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


_KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp", "HUGEINT": "hugeint",
}


def compare(con, df, sql: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    got = df.collect()
    cur = con.execute(sql)
    wanted, desc = cur.fetchall(), cur.description
    names = [d[0] for d in desc]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    a, b = _rows(df.columns, map(tuple, got)), _rows(names, wanted)
    if len(a) != len(b):
        return f"row count {len(a)} against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference {dict(zip(sorted(names), zip(x, y)))}"
    types = {d[0]: _KIND.get(str(d[1]).split("(")[0], str(d[1])) for d in desc}
    odd = {
        f.name: (f.dataType.simpleString(), types[f.name])
        for f in df.schema
        if f.dataType.simpleString().replace("_ntz", "") != types[f.name]
    }
    if odd:
        return f"types differ: {odd}"
    return "no rows" if not a else None


def main() -> int:
    import __spark_entry__ as entry
    from wardline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con = local_session("oracle-check"), connect(folder)
    fns, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in fns.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(con, fn(spark, folder), sqls[name])
            else:
                n = fn(spark, folder).count()
                problem = None if n else "no rows"
                name += f" [rows only: {n}]"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:5.1f}s {name} {problem or ''}", flush=True)
    print(f"{bad} problems; no query for {sorted(set(sqls) - set(fns))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
