"""Holds a Spark result against DuckDB's on the same tables, as multisets of rows."""

import glob
import math
import os


def plain(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        v = v.item() if getattr(v, "ndim", 0) == 0 else v.tolist()
    if str(v) in ("<NA>", "NaT"):
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v if isinstance(v, (int, str, bool, tuple)) else str(v)


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted(map(repr, (tuple(map(plain, r)) for r in df[columns].itertuples(index=False))))


def duckdb_rows(sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return rows_of(con.execute(sql).df())
