"""Command line: the batch stages and page reads, for ``python -m riskmart`` or spark-submit.

    python -m riskmart all     --war war.csv --economics economics.sql --root DIR --as-of 2026-03-25
    python -m riskmart ingest  --war war.csv --economics economics.sql --root DIR --as-of 2026-03-25
    python -m riskmart curate  --root DIR --as-of 2026-03-25 [--database default]
    python -m riskmart marts   --root DIR [--database default]
    python -m riskmart page    finance 3 [--database default]
    python -m riskmart marts-list [--database default]
    python -m riskmart views   [--database default]

The session comes from ``SparkSession.builder.getOrCreate()``: cluster settings
are given to spark-submit, not here.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="riskmart")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("all", "ingest", "curate", "marts"):
        c = sub.add_parser(name)
        c.add_argument("--root", required=True, help="zone root on shared storage")
        c.add_argument("--database", default="default")
        if name in ("all", "ingest"):
            c.add_argument("--war", required=True)
            c.add_argument("--economics", required=True)
            c.add_argument("--dump-mode", choices=("locale", "strict"), default="locale")
            c.add_argument("--infer-schema", action="store_true",
                           help="infer the war file's types (extra pass) instead of the fixed schema")
        c.add_argument("--as-of", type=date.fromisoformat, default=None if name == "marts" else date.today(),
                       help="load date; marts: the last one by default")
        if name in ("all", "ingest", "curate"):
            c.add_argument("--overwrite", choices=("static", "dynamic"), default="static")
            c.add_argument("--id-type", default="bigint", help="int reproduces the reference's curated type")
        if name in ("all", "marts"):
            c.add_argument("--rank", choices=("buckets", "plain"), default="buckets")
    pg = sub.add_parser("page")
    pg.add_argument("mart")
    pg.add_argument("number", nargs="?", default="1")
    pg.add_argument("--database", default="default")
    ls = sub.add_parser("marts-list")
    ls.add_argument("--database", default="default")
    vw = sub.add_parser("views", help="country / sector / region views from the stored marts")
    vw.add_argument("--database", default="default")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from riskmart.operators.metrics import StageMetrics
    from riskmart.operators.paging import mart_names, page_mart
    from riskmart.plans import stages

    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"riskmart-{args.command}").getOrCreate()
    if args.command == "page":
        try:
            out = page_mart(spark, args.mart, args.number, args.database).to_dict()
        except Exception as exc:             # the API answered failures with an error body
            out = {"error": str(exc).splitlines()[0] if str(exc) else type(exc).__name__}
    elif args.command == "marts-list":
        out = {"endpoints": [f"{m}?page=1" for m in mart_names(spark, args.database)]}
    elif args.command == "views":
        from riskmart.operators import views
        from riskmart.plans.layout import save_table
        db = args.database
        built = {
            "view_country": views.country_crisis(spark.table(f"{db}.gold_output_government")),
            "view_sector": views.sector_exposure(spark.table(f"{db}.gold_output_finance")),
            "view_region": views.regional_need(spark.table(f"{db}.gold_output_humanitarian")),
        }
        for name, df in built.items():
            save_table(df, f"{db}.{name}")
        out = {"tables": [f"{db}.{name}" for name in built]}
    elif args.command == "all":
        result = stages.run_all(spark, args.war, args.economics, args.root, args.as_of,
                                args.database, args.dump_mode, args.id_type, args.rank,
                                war_schema=None if args.infer_schema else stages.WAR_SOURCE_SCHEMA,
                                overwrite=args.overwrite)
        out = {"metrics": result.metrics.records}
    else:
        paths, metrics = stages.Paths(args.root), StageMetrics()
        if args.command == "ingest":
            stages.ingest(spark, args.war, args.economics, paths, args.as_of, metrics,
                          args.dump_mode, args.overwrite,
                          None if args.infer_schema else stages.WAR_SOURCE_SCHEMA)
        elif args.command == "curate":
            stages.curate(spark, paths, args.as_of, metrics, args.database, args.id_type,
                          overwrite=args.overwrite)
        else:
            stages.build_marts(spark, paths, metrics, args.database, rank_strategy=args.rank, as_of=args.as_of)
        out = {"metrics": metrics.collect()}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    sys.exit(1 if "error" in main(sys.argv[1:]) else 0)
