"""Compare a query with its SQL on DuckDB: names, types, rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """(rows, differences)."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return 0, [f"columns {sorted(set(names) ^ set(rel.columns))}"]
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    bad = [f"{c}: {t} / {want_types[c]}" for c, t in df.dtypes if TYPES.get(t, t) != want_types[c]]
    got = df.select(*names).toArrow().to_pylist()
    at = [rel.columns.index(n) for n in names]
    want = [tuple(r[i] for i in at) for r in rel.fetchall()]
    got = [tuple(r[n] for n in names) for r in got]
    if len(got) != len(want):
        bad.append(f"rows {len(got)} / {len(want)}")
    else:
        pairs = zip(sorted(got, key=_key), sorted(want, key=_key))
        diff = [(g, w) for g, w in pairs if g != w]
        if diff:
            g, w = diff[0]
            cells = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
            bad.append(f"{len(diff)} rows differ, first: {cells[:4]}")
    return len(got), bad
