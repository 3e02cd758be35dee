"""Side-by-side comparison of a Spark result and its SQL oracle."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def kind(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint", "long"):
        return "int"
    if t.startswith("decimal") or t in ("double", "float"):
        return "num"
    return {"varchar": "string"}.get(t, t)


def compare(con, df, sql: str) -> str | None:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    duck_types = {d[0]: kind(str(d[1])) for d in cur.description}
    want = cur.fetchall()
    rows = df.collect()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    spark_types = {n: kind(t) for n, t in df.dtypes}
    bad = {n: (spark_types[n], duck_types[n]) for n in order if spark_types[n] != duck_types[n]
           and not spark_types[n].startswith(("array", "map", "struct"))}
    a = Counter(tuple(norm(r[n]) for n in order) for r in rows)
    at = {n: i for i, n in enumerate(names)}
    b = Counter(tuple(norm(r[at[n]]) for n in order) for r in want)
    if a != b:
        left, right = list((a - b).elements()), list((b - a).elements())
        msg = f"rows {len(rows)} vs {len(want)}; only spark {len(left)}, only sql {len(right)}"
        if left and right:
            x = sorted(left, key=repr)[0]
            y = min(right, key=lambda r: sum(p != q for p, q in zip(x, r)))
            for n, p, q in zip(order, x, y):
                if p != q:
                    p, q = str(p), str(q)
                    i = next((i for i, (s, t) in enumerate(zip(p, q)) if s != t), min(len(p), len(q)))
                    msg += f"\n   {n}@{i}: {p[max(0,i-60):i+60]!r}\n        vs {q[max(0,i-60):i+60]!r}"
        else:
            msg += f"\n   {str((left or right)[0])[:600]}"
        return msg
    if not rows:
        return "no rows"
    return f"types {bad}" if bad else None
