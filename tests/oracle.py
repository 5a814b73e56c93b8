"""Run registered queries next to their SQL and compare rows, names and kinds of types."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


_KIND = {"bigint": "bigint", "integer": "int", "int": "int", "smallint": "smallint", "varchar": "string",
         "string": "string", "double": "double", "boolean": "boolean", "date": "date"}


def compare(spark, con, sf_dir, fn, sql) -> str | None:
    """None when equal, otherwise what differs."""
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = _rows(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, SQL has {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference\n  {str(a)[:600]}\n  {str(b)[:600]}"
    mine = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {c: _KIND.get(str(t).lower(), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    kinds = {c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]}
    return f"types {kinds}" if kinds else None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.session import make_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            problem = compare(spark, con, sf_dir, fn, sql) if sql else f"no SQL, {fn(spark, sf_dir).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'equal'}", flush=True)
    print(f"{bad} to look at")
