import os

import duckdb

DATA = "/root/testdata/sf0.001"


def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows_of_sql(con, sql):
    c = con.execute(sql)
    names = [x[0] for x in c.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in c.fetchall()), key=repr)


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
