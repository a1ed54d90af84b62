"""Compare catalog queries with their DuckDB twins on the test tables.

    python tools/check_oracle.py <sf> [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from corpusloom.catalog import QUERIES  # noqa: E402
from corpusloom.oracle import SQL  # noqa: E402
from corpusloom.session import local_session  # noqa: E402


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
            return None
        if isinstance(value, float):
            return value + 0.0
        return value.item() if hasattr(value, "item") else value

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


def main(sf: str, names: list[str]) -> int:
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8, spark__ui__showConsoleProgress="false")
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    bad = []
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            ours = df.toPandas()
            spent = time.time() - started
            if name not in SQL:
                print(f"{name:32s} {len(ours):8d} rows, no oracle, {spent:.1f}s", flush=True)
                continue
            started = time.time()
            theirs = con.execute(SQL[name]).df()
            duck = time.time() - started
            verdict = "ok"
            if sorted(ours.columns) != sorted(theirs.columns):
                verdict = f"COLUMNS {sorted(ours.columns)} {sorted(theirs.columns)}"
            else:
                a, b = canonical(ours), canonical(theirs)
                if a != b:
                    only = [x for x, y in zip(a, b) if x != y][:2], [y for x, y in zip(a, b) if x != y][:2]
                    verdict = f"DIFFERS {len(a)} {len(b)} {str(only)[:600]}"
            kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns if c in theirs.columns}
            odd = {c: k for c, k in kinds.items() if k[0] != k[1]}
            print(f"{name:32s} {len(ours):8d} rows {spent:6.1f}s duckdb {duck:5.1f}s {verdict} {odd or ''}", flush=True)
        except Exception as failure:  # report and go on with the next query
            verdict = f"FAILED {type(failure).__name__} {str(failure)[:700]}"
            print(f"{name:32s} {verdict}", flush=True)
        if verdict != "ok":
            bad.append(name)
    print("bad:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
