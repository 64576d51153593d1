from datetime import date

from pyspark.sql import types as T

from riskmart.plans.layout import read_partitioned
from riskmart.streaming.ingest import delimited_stream, ingest_available

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("cost", T.DoubleType())])


def _write(path, rows):
    with open(path, "w") as fh:
        fh.write("k;cost\n")
        for k, cost in rows:
            fh.write(f"{k};{cost}\n")


def test_incremental_runs_pick_up_only_new_files(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    import os
    os.makedirs(src)
    _write(f"{src}/a.csv", [(1, "1,5"), (2, "2,06957E+2")])
    stream = delimited_stream(spark, src, SCHEMA, sep=";", decimal_comma=("cost",))
    ingest_available(stream, out, ckpt, date(2026, 3, 24))
    _write(f"{src}/b.csv", [(3, "3")])
    stream = delimited_stream(spark, src, SCHEMA, sep=";", decimal_comma=("cost",))
    ingest_available(stream, out, ckpt, date(2026, 3, 25))
    rows = sorted((r.k, r.cost, r.day) for r in read_partitioned(spark, out).collect())
    assert rows == [(1, 1.5, 24), (2, 206.957, 24), (3, 3.0, 25)]
