"""Row-level comparison of a Spark result with DuckDB's answer to the same question."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, bool) or v is None:
            return v
        return round(float(v), 6) + 0.0 if isinstance(v, (int, float)) else v

    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both give the same multiset of rows under the same column names."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _rows(names, answer.fetchall())
    have = _rows(df.columns, df.collect())
    if want == have:
        return None if want else "both empty"
    extra, lacking = have - want, want - have
    return (
        f"{sum(have.values())} against {sum(want.values())} rows in order of {sorted(names)}; "
        f"only here {list(extra)[:2]}; only there {list(lacking)[:2]}"
    )
