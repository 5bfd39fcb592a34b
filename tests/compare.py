"""Run registered queries beside their SQL oracles and report differences.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if isinstance(frame[name].dtype, pd.api.extensions.ExtensionDtype) and frame[name].dtype.kind in "if":
            frame[name] = frame[name].astype(float)
    for name in frame.columns:
        if frame[name].dtype == object:
            kinds = {type(v).__name__ for v in frame[name].dropna().head(50)}
            if kinds & {"Decimal", "float", "int"}:
                frame[name] = frame[name].astype(float)
            else:
                frame[name] = frame[name].astype(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def _kind(dtype) -> str:
    if isinstance(dtype, pd.api.extensions.ExtensionDtype):
        return dtype.kind + str(dtype.itemsize)
    return "text" if dtype == object else np.dtype(dtype).kind + str(np.dtype(dtype).itemsize)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    types = [
        f"{c}: {ours[c].dtype} / {theirs[c].dtype}"
        for c in ours.columns
        if len(ours) and not ours[c].isna().any() and _kind(ours[c].dtype) != _kind(theirs[c].dtype)
    ]
    a, b = _normal(ours), _normal(theirs)
    for name in a.columns:
        left, right = a[name], b[name]
        if left.dtype.kind in "fiub" and right.dtype.kind in "fiub":
            same = np.isclose(left.astype(float), right.astype(float), rtol=0, atol=1e-9, equal_nan=True)
            same |= left.to_numpy() == right.to_numpy()
            if left.dtype.kind == "f" and right.dtype.kind == "f":  # -0.0 and 0.0 differ when hashed
                same &= ~((left == 0) & (right == 0) & (np.signbit(left) != np.signbit(right))).to_numpy()
        else:
            same = (left.astype(str) == right.astype(str)).to_numpy()
        if not same.all():
            at = int(np.argmin(same))
            return f"{name}: {int((~same).sum())} differ, first {left[at]!r} != {right[at]!r}"
    return f"types {types}" if types else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pulsegrid.runtime import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            ours = fn(spark, sf_dir).toPandas()
            spent = time.time() - start
            start = time.time()
            verdict = differences(ours, con.sql(sql[name]).df()) if name in sql else "no oracle"
        except Exception as error:  # report and go on with the next query
            ours, spent, verdict = [], time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in (None, "no oracle")
        print(f"{name:34s} rows {len(ours):7d} spark {spent:6.2f}s sql {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
