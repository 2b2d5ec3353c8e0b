import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of(df):
    return sorted([tuple(norm(x) for x in r) for r in df.collect()], key=_key)


def duck_rows(con, sql, cols):
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols), (dcols, cols)
    order = [dcols.index(c) for c in cols]
    return sorted([tuple(norm(r[i]) for i in order) for r in cur.fetchall()], key=_key)
