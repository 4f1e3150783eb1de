"""Side-by-side check of a contract query against its DuckDB statement.

Columns are compared by name (sorted), rows order-insensitively; floats are
never produced by contract queries, so values compare as text.
"""

from __future__ import annotations

import duckdb

from codefacts.sources.tables import TABLES


def duck(sf_dir: str) -> "duckdb.DuckDBPyConnection":
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    try:
        import math
        if isinstance(v, float) and math.isnan(v):
            return "<null>"
    except Exception:
        pass
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(columns)


def compare(df, con, sql: str) -> dict:
    spark_rows = [tuple(r) for r in df.collect()]
    s_rows, s_cols = rows_of(df.columns, spark_rows)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows, d_cols = rows_of(d_cols, res.fetchall())
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "schema_match": s_cols == d_cols, "value_match": s_rows == d_rows}
    if not out["schema_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    if out["schema_match"] and not out["value_match"]:
        ss, dd = set(s_rows), set(d_rows)
        out["only_spark"] = sorted(ss - dd)[:5]
        out["only_oracle"] = sorted(dd - ss)[:5]
    return out
