"""Records over several lines against whole-file readings, with splits of a few bytes."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from riskmart.sources import dump
from riskmart.sources.delimited import read_delimited
from riskmart.sources.records import read_delimited_records, sql_statements

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("cost", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward(draw):
    return "".join(draw.choice(['a', ';', '"', "'", '\n', '\n\n', ' ', 'é', '-- x', 'long word ' * 4]) for _ in range(draw.randint(1, 9)))


def test_quoted_line_breaks_at_split_borders(spark, tmp_path, small_splits):
    draw = random.Random(3)
    want = []
    for f in range(3):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=";", lineterminator="\n")
        writer.writerow(["id", "text", "cost"])
        for i in range(60):
            text = "x" + awkward(draw) + "y"
            writer.writerow([100 * f + i, text, "1,5"])
            want.append((100 * f + i, text, 1.5))
        (tmp_path / f"f{f}.csv").write_text(out.getvalue())
    got = read_delimited_records(spark, str(tmp_path), SCHEMA, decimal_comma=("cost",))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    whole = read_delimited(spark, str(tmp_path), SCHEMA, decimal_comma=("cost",), multi_line=True)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(want)


def test_odd_quotes_leave_the_other_files_alone(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id;text;cost\n1;"one\ntwo";2,5\n\n2;x;3\n')
    (tmp_path / "b.csv").write_text('id;text;cost\n3;"stray;1\n4;z;1\n')
    (tmp_path / "c.csv").write_text("id;text;cost\n")
    got = read_delimited_records(spark, str(tmp_path), SCHEMA, decimal_comma=("cost",)).collect()
    assert {(r.id, r.text) for r in got} >= {(1, "one\ntwo"), (2, "x"), (4, "z")} and len(got) == 4


def test_statements_over_several_lines(spark, tmp_path, small_splits):
    draw = random.Random(4)
    want, parts = [], ["-- it's a dump\n# don't\nCREATE TABLE t (\n id BIGINT\n);\n\n"]
    for i in range(80):
        text = "x" + awkward(draw).replace("-- x", "") + "y"
        quoted = text.replace("'", draw.choice(["''", "\\'"]))
        between = draw.choice([" ", "\n", "\n-- isn't counted\n", "\n\n  "])
        parts.append(f"INSERT INTO t VALUES{between}({i}, '{quoted}',{between}2.5),{between}({i + 1000}, 'b', 1E0);\n")
        want += [(i, text, 2.5), (i + 1000, "b", 1.0)]
    (tmp_path / "d.sql").write_text("".join(parts))
    got = dump.read_insert_dump(spark, str(tmp_path), SCHEMA, statements=True)
    assert got.rejects.count() == 0
    assert sorted(tuple(r) for r in got.rows.collect()) == sorted(want)


def test_a_statement_without_its_end_is_rejected_alone(spark, tmp_path, small_splits):
    (tmp_path / "d.sql").write_text("INSERT INTO t VALUES (1, 'a\nb', 1.5)\nINSERT INTO t VALUES\n(2, 'c', 2.5);\n")
    rows, rejects = dump.read_insert_dump(spark, str(tmp_path), SCHEMA, statements=True)
    assert [tuple(r) for r in rows.collect()] == [(2, "c", 2.5)]
    assert [(r.line, r.reason) for r in rejects.collect()] == [
        ("INSERT INTO t VALUES (1, 'a\nb', 1.5)", "statement does not end with ');'")]
    (tmp_path / "none.sql").write_text("")
    assert sql_statements(spark, str(tmp_path / "none.sql")).count() == 0
