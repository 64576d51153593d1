"""Summarise the physical plan of each registered query.

``python -m riskmart.plans.planreport [sf_dir] [names…]`` prints, per query:
shuffles (hash / range / single-partition exchanges), broadcasts, scans with
pushed filters, and any Python evaluation node. Queries that write intermediate
files do so while they are built, as in a real run.
"""

from __future__ import annotations

import re
import sys


def summarise(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "scans": len(re.findall(r"FileScan|Scan parquet|Scan ExistingRDD", plan)),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan))),
        "python": bool(re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapIn(Arrow|Pandas)"
                                 r"|FlatMap(Co)?GroupsIn(Arrow|Pandas)", plan)),
    }


def main(argv: list[str]) -> int:
    import importlib.util

    from riskmart.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spec = importlib.util.spec_from_file_location("entry", "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = build_session("local[8]")
    queries = entry.queries()
    for name in argv[2:] or sorted(queries):
        s = summarise(queries[name](spark, sf_dir))
        pushed = "; ".join(p for p in s["pushed_filters"] if "EqualTo" in p or "In(" in p)
        print(f"{name:28s} hash={s['hash_shuffles']} range={s['range_shuffles']} "
              f"single={s['single_partition']} bcast={s['broadcasts']} scans={s['scans']} "
              f"python={s['python']} {('pushed: ' + pushed) if pushed else ''}", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
