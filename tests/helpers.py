"""Spark rows against DuckDB rows."""

from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        con.execute(f"create view {name} as select * from '{path / '*.parquet' if path.is_dir() else path}'")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    frame = frame.reindex(sorted(frame.columns), axis=1)

    def plain(v):
        if pd.isna(v):
            return "null"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return list(frame.columns), sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))
