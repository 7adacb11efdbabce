"""Compare every query that has an oracle with DuckDB."""

from __future__ import annotations

import glob
import math
import os


def rows(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
            return None
        if hasattr(v, "isoformat"):
            return str(v)[:10] if str(v)[10:] in ("", " 00:00:00") else str(v)
        if isinstance(v, (int, bool)) or hasattr(v, "dtype") and v.dtype.kind in "iub":
            return int(v)
        return round(float(v), 4) if isinstance(v, float) or hasattr(v, "dtype") else v

    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=repr)


def duck(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con.execute(sql).df()
