from riskmart.sources.dump import (ECONOMICS_DUMP_SCHEMA, insert_lines, parse_insert_dump,
                                   read_insert_dump)

# Two economics rows as logged by the reference run, rebuilt as INSERT lines
# (the original dump is not available).
LOGGED_1 = ("INSERT INTO economics VALUES (1, 7.49, 21.78, 14.29, 'Resolved', 19.9, 19.97, 28.67, "
            "10.39, 15.0, 38487, -36.86, 97.41, 170.33, 2,60911E+11, 9.0549997E14, 15.5, 27.09, Yes);")
LOGGED_2 = ("INSERT INTO economics VALUES (2, 8.18, 23.0, 14.82, 'Ongoing', 19.92, 8.49, 18.93, "
            "8.45, 12.92, 166213, -64.99, 73.68, 41.97, 5,85916E+11, 11.95, 34.76, Yes);")

LINES = [
    "CREATE TABLE economics (Conflict_Id INT);",
    LOGGED_2,
    "  insert into economics VALUES (3, 1, 2, 3, 'O''Brien', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, NULL);",
    "INSERT INTO economics VALUES (4, 1, 2, 3, 'x', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 'No')",
    "INSERT INTO economics VALUES (5, 1, 2, 3, 'x', 1, 2, 3, 4, 5, 6.5, 7, 8, 9, 10, 11, 12, 'No');",
    "INSERT INTO economics VALUES (6, 1, 2, 3, '', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 'No'), "
    "(7, 1, 2, 3, 'a,(b)', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 'No');",
    "INSERT INTO economics VALUES (8, 1, 2, 3, 'x', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 'No');",
    "INSERT INTO economics VALUES (9, 1, 2, 3, 'x', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 'No');",
    "INSERT INTO economics VALUES (-10, -1.5e3, 2E-2, 3, 'x', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 'No');",
    "INSERT INTO economics VALUES ('eleven', 1, 2, 3, 'x', 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 'No');",
]


def _parse(spark, lines, mode):
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    return parse_insert_dump(df, ECONOMICS_DUMP_SCHEMA, mode)


def test_strict_reproduces_reference_shift(spark):
    # The unquoted decimal-comma cost splits in two and the bareword is lost:
    # the reference logged cost=5, informal pre-war=8.5916E15, profiteering='34.76'.
    row = _parse(spark, [LOGGED_2], "strict").collect()[0]
    assert row.reject_reason is None
    assert row.Estimated_Reconstruction_Cost_USD == 5
    assert row.Informal_Economy_Pre_War_pct == 8.5916e15
    assert row.Informal_Economy_During_War_pct == 11.95
    assert row.War_Profiteering_Documented == "34.76"
    # Columns 1-14 (all the gold tables read) are unaffected.
    assert (row.Conflict_Id, row.Status, row.GDP_Change_pct) == (2, "Ongoing", -64.99)


def test_locale_reads_the_right_columns(spark):
    row = _parse(spark, [LOGGED_2], "locale").collect()[0]
    assert row.reject_reason is None
    assert row.Estimated_Reconstruction_Cost_USD == 585916000000
    assert row.Informal_Economy_Pre_War_pct == 11.95
    assert row.Informal_Economy_During_War_pct == 34.76
    assert row.War_Profiteering_Documented == "Yes"


def test_locale_must_have_lines(spark):
    rows = {(r.Conflict_Id, r.tuple_no): r for r in _parse(spark, LINES, "locale").collect()}
    assert rows[(3, 0)].Status == "O'Brien" and rows[(3, 0)].War_Profiteering_Documented is None
    assert rows[(3, 0)].reject_reason is None
    assert "end with" in rows[(None, None)].reject_reason          # the line as a whole
    assert rows[(5, 0)].reject_reason == "bad Households_Fallen_Into_Poverty"
    assert rows[(6, 0)].Status == "" and rows[(7, 1)].Status == "a,(b)"
    assert rows[(8, 0)].reject_reason == "expected 18 values, got 17"
    assert rows[(9, 0)].reject_reason == "expected 18 values, got 19"
    neg = rows[(-10, 0)]
    assert neg.reject_reason is None and neg.Pre_War_Unemployment_pct == -1500.0
    assert neg.During_War_Unemployment_pct == 0.02
    assert rows[(None, 0)].reject_reason == "bad Conflict_Id"


def test_strict_rejects(spark):
    out = _parse(spark, LINES, "strict").collect()
    ok = sorted(r.Conflict_Id for r in out if r.reject_reason is None)
    # The non-INSERT line is skipped, not rejected; 'O''Brien', no ';', 6.5 in an
    # int slot, the two-tuple line and the 17/19 value lines are rejected.
    assert ok == [-10, 2]
    assert len(out) == len(LINES) - 1


def test_conservation_and_roundtrip(spark, tmp_dir):
    df = spark.range(2000).selectExpr("id AS k", "concat('n''', id) AS name",
                                      "CAST(id % 7 AS INT) AS size", "id / 3.0D AS price")
    path = f"{tmp_dir}/dump"
    insert_lines(df, "t").write.text(path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("size", T.IntegerType()),
                           T.StructField("price", T.DoubleType())])
    rows, rejects = read_insert_dump(spark, path, schema, mode="locale")
    assert rejects.count() == 0
    assert sorted(rows.collect()) == sorted(df.collect())


def test_no_python_in_plan(spark):
    plan = _parse(spark, LINES, "locale")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan


def _two(spark, lines, mode="locale"):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [(r.id, r.t, r.reject_reason) for r in parse_insert_dump(df, schema, mode).collect()]


def test_no_tuple_is_lost_without_a_reject(spark):
    got = _two(spark, [r"INSERT INTO t VALUES (1,'O\'Brien'),(2,'b');",
                       "INSERT INTO t VALUES (6,'a'), 7,'lost', (8,'c');",
                       "INSERT INTO t VALUES (9,(1));",
                       "INSERT INTO t VALUES (10,'x' junk!);",
                       "INSERT INTO t VALUES (11,'line\u2028separator');",
                       r"INSERT INTO t VALUES (12,'back\\slash \n');",
                       "INSERT INTO t VALUES (12.5,'x');"])
    assert got == [(1, "O'Brien", None), (2, "b", None),
                   (None, None, "text outside the value tuples"), (None, None, "text outside the value tuples"),
                   (10, "x", "text between the values"), (11, "line\u2028separator", None),
                   (12, r"back\slash \n", None), (None, "x", "bad id")]


def test_strict_reads_line_separators_and_whole_ids(spark):
    assert _two(spark, ["INSERT INTO t VALUES (11,'line\u2028separator');", "INSERT INTO t VALUES (12.5,'x');"],
                "strict") == [(11, "line\u2028separator", None), (None, "x", "bad id")]


def test_written_dump_reads_back_equal(spark, tmp_dir):
    import math
    values = ["", " pad ", "O'Brien", "''", "\\", "a\\'b", "x;y", "(a),(b)", "1,2", "NULL", "tab\there", "\u2028", "é漢"]
    numbers = [1.5, -2e-300, math.inf, -math.inf, math.nan, None]
    rows = [(i, values[i % len(values)] if i % 17 else None, numbers[i % len(numbers)]) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, s string, x double")
    insert_lines(df, "t").write.text(f"{tmp_dir}/d")
    got, rejects = read_insert_dump(spark, f"{tmp_dir}/d", df.schema, mode="locale")
    assert rejects.count() == 0
    same = {r.k: (r.s, repr(r.x)) for r in got.collect()}
    assert same == {k: (s, repr(x)) for k, s, x in rows}


def test_written_csv_reads_back_equal(spark, tmp_dir):
    from riskmart.sources.delimited import read_delimited, write_delimited
    values = [" pad ", "a;b", 'say "hi"', "two\nlines", "'", "x,y", "\\", 'end\\"', "plain", None]
    df = spark.createDataFrame(list(enumerate(values)), "k long, s string")
    write_delimited(df, f"{tmp_dir}/c")
    got = read_delimited(spark, f"{tmp_dir}/c", df.schema, multi_line=True)
    assert {r.k: r.s for r in got.collect()} == dict(enumerate(values))
