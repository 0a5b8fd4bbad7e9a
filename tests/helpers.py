"""Shared comparison helpers for tests."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "asDict"):
        return canon(tuple(v.asDict().values()))
    return ("s", str(v))


def rows(df, cols=None):
    cols = sorted(cols or df.columns)
    return collections.Counter(tuple(canon(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql_text):
    cur = con.execute(sql_text)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), collections.Counter(tuple(canon(r[i]) for i in order) for r in data)
