"""Run a query and its SQL twin and compare rows as multisets, columns by name."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(columns, tuples) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in tuples)


def difference(df, con, sql: str) -> str:
    """Empty when equal."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    ours, theirs = rows(df.columns, map(tuple, df.collect())), rows(names, expected.fetchall())
    if ours == theirs:
        return ""
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}, "
        f"only theirs {list((theirs - ours).items())[:3]}"
    )
