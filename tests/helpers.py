import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in res.fetchall()), key=repr), sorted(names)
