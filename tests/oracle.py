"""Compare a Spark result with DuckDB's, whatever the row order."""

from __future__ import annotations

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted_rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(picked, key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want_names, want = _sorted_rows(want_names, cursor.fetchall())
    got_names, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got_names == want_names
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{dict(zip(got_names, mine))} != {dict(zip(got_names, theirs))}"
    assert want, "the query has no rows to compare"
