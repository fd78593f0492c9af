"""Compare a named query with its SQL. ``python -m tests.compare [sf_dir] [query ...]`` checks from the shell."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd


def reference(sql: str, sf: str) -> pd.DataFrame:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).df()


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    rows = df.astype(object).where(df.notna(), None)
    return rows.sort_values(by=list(rows.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def mismatch(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns}
    if any(a != b for a, b in kinds.values() if "O" not in (a, b)):
        return f"types {kinds}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    differ = [i for i, (x, y) in enumerate(zip(a.itertuples(index=False), b.itertuples(index=False))) if x != y]
    return f"{len(differ)} rows differ, first {tuple(a.iloc[differ[0]])} != {tuple(b.iloc[differ[0]])}" if differ else None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from sluiceway.session import local_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    bad = 0
    for name, query in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            got = query(spark, sf).toPandas()
            took = time.time() - start
            sql = oracle_sql().get(name)
            problem = mismatch(got, reference(sql, sf)) if sql else None
            note = f"{len(got)} rows" + ("" if sql else " (no SQL)")
        except Exception as failure:  # noqa: BLE001 - the report lists every query
            took, note, problem = time.time() - start, "", f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {took:6.2f}s {note} {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
