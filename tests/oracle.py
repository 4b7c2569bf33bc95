"""Comparison of a query with its SQL in DuckDB."""

import duckdb

TABLES = "problems selected scored documents reading_labels benchmark_items mix_targets events orders lineitem customer part supplier nation region embeddings".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9))
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(_plain, v)) + "]"
    return repr(v)


def same_rows(df, con, sql: str) -> None:
    result = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    mine = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    at = [result.columns.index(c) for c in columns]
    theirs = sorted(tuple(_plain(r[i]) for i in at) for r in result.fetchall())
    assert mine == theirs
