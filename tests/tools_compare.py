"""Order-insensitive result comparison used by the tests."""

import math


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def compare(sdf, con, sql) -> bool:
    cols = sorted(sdf.columns)
    srows = sorted("|".join(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    idx = [names.index(c) for c in cols]
    drows = sorted("|".join(_norm(r[i]) for i in idx) for r in cur.fetchall())
    return srows == drows
