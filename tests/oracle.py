"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = canonical([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return (f"{len(got[1])} rows != {len(want[1])} rows; spark only {sorted(a - b)[:3]}; "
                f"sql only {sorted(b - a)[:3]}")
    return None
