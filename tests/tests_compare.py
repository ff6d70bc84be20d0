"""Comparing a query's rows with those of its SQL."""

import datetime
import decimal
import math


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, int):
        return f"{float(v):.6g}" if abs(v) < 10**6 else str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(map(cell, r)) for r in df.select(*cols).collect())


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(cell(r[i]) for i in at) for r in cur.fetchall())
