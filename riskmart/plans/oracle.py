"""Compare a Spark query with its DuckDB SQL on the driver's parquet tables.

Used by the tests and by hand (``python -m riskmart.plans.oracle sf_dir [names]``).
Columns are compared by name; rows as sorted multisets. Floats must be equal
bit for bit unless ``rel_tol`` is given.
"""

from __future__ import annotations

import math
import sys

from riskmart.plans.shaping import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, v)
    if isinstance(v, (list, tuple)):
        return (3, tuple(_norm(x) for x in v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (4, v) if isinstance(v, (int, bool)) else (5, str(v))


def compare(spark_df, con, sql: str, rel_tol: float = 0.0) -> tuple[bool, str]:
    s_cols = spark_df.columns
    rows = spark_df.collect()
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    names = sorted(s_cols)
    s_idx = [s_cols.index(n) for n in names]
    o_idx = [o_cols.index(n) for n in names]
    s_vals = sorted(tuple(_norm(r[i]) for i in s_idx) for r in rows)
    o_vals = sorted(tuple(_norm(r[i]) for i in o_idx) for r in o_rows)
    if len(s_vals) != len(o_vals):
        return False, f"row counts differ: spark={len(s_vals)} oracle={len(o_vals)}"
    bad = 0
    first = None
    for a, b in zip(s_vals, o_vals):
        if a == b:
            continue
        if rel_tol and all(x == y or (x[0] == 2 and y[0] == 2 and
                                      math.isclose(x[1], y[1], rel_tol=rel_tol, abs_tol=1e-12))
                           for x, y in zip(a, b)):
            continue
        bad += 1
        first = first or (a, b)
    if bad:
        return False, f"{bad} rows differ; first: spark={first[0]} oracle={first[1]}"
    return True, f"{len(s_vals)} rows equal"


def main(argv: list[str]) -> int:
    import importlib.util
    import time

    from riskmart.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spec = importlib.util.spec_from_file_location("entry", "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = build_session("local[8]")
    con = duckdb_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(qs)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                ok, msg = compare(df, con, sqls[name])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as exc:  # report and go on with the next query
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.1f}s {msg}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
