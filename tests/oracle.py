"""Run registered queries beside their SQL twins.

    python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    out = []
    for row in frame.itertuples(index=False, name=None):
        cells = []
        for v in row:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
                cells.append("NULL")
            elif isinstance(v, pd.Timestamp):
                cells.append(str(v.to_pydatetime()))
            elif hasattr(v, "tolist"):
                cells.append(repr(v.tolist()))
            elif isinstance(v, float) and v.is_integer():
                cells.append(repr(int(v)))
            else:
                cells.append(repr(v) if isinstance(v, float) else str(v))
        out.append(tuple(cells))
    return sorted(out)


def compare(spark, con, sf_dir: str, query) -> str:
    """Empty when equal, else what differs."""
    ours = query.run(spark, sf_dir).toPandas()
    if query.sql is None:
        return "" if len(ours.columns) else "no columns"
    theirs = con.execute(query.sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = [
        f"{c}: {ours[c].dtype} != {theirs[c].dtype}" for c in ours.columns
        if ours[c].dtype.kind in "iufb" and theirs[c].dtype.kind in "iufb" and ours[c].dtype.kind != theirs[c].dtype.kind
        and not ours[c].isna().any()
    ]
    if kinds:
        return f"types {kinds}"
    a, b = _canonical(ours), _canonical(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {str(bad[0])[:600]}" if bad else ""


def main(argv: list[str]) -> int:
    import conftest
    from lakestrata.workload.registry import load_all

    sf_dir, names = argv[0], argv[1:]
    spark, con = conftest.make_session(), connect(sf_dir)
    failures = 0
    for name, query in load_all().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, query)
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
