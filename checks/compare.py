"""Run registered queries against their SQL: ``python -m checks.compare <folder> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from loyalspan.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return None
        if isinstance(value, bool):
            return value
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if hasattr(value, "item"):
            value = value.item()
        return float(value) + 0.0 if isinstance(value, (int, float)) else value

    rows = [tuple(cell(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def compare(spark, db, name: str, folder: str) -> tuple[bool, str]:
    started = time.time()
    ours = QUERIES[name](spark, folder).toPandas()
    took = time.time() - started
    if name not in ORACLES:
        return True, f"{len(ours)} rows, no SQL, {took:.1f}s"
    theirs = db.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return False, f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    a, b = canonical(ours), canonical(theirs)
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if len(a) != len(b) or different:
        return False, f"{len(a)} against {len(b)} rows, {len(different)} differ, first {different[:1]}"
    return True, f"{len(a)} rows, {took:.1f}s"


def main(folder: str, names: list[str]) -> int:
    spark, db = local_session(8), connect(folder)
    failed = 0
    for name in names or QUERIES:
        try:
            same, detail = compare(spark, db, name, folder)
        except Exception as error:  # keep going: this is a report over all queries
            same, detail = False, f"{type(error).__name__}: {str(error)[:400]}"
        failed += not same
        print(("ok  " if same else "FAIL"), name, detail, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
