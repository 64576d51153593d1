"""The dump parser's work per value: cleaned in one expression, cast once."""

from pyspark.sql import types as T

from riskmart.sources.dump import ECONOMICS_DUMP_SCHEMA, parse_insert_dump


def test_values_cleaned_in_one_expression_and_cast_once(spark):
    lines = spark.createDataFrame([("INSERT INTO t VALUES (1);",)], "value string")
    plan = parse_insert_dump(lines)._jdf.queryExecution().optimizedPlan().toString()
    casts = sum(not isinstance(f.dataType, T.StringType) for f in ECONOMICS_DUMP_SCHEMA) + 2    # the float-long takes three
    assert plan.count("regexp_replace(") == 1 and plan.count("try_cast(") == casts


def test_whole_numbers_written_as_floats(spark):
    schema = T.StructType([T.StructField("line", T.LongType()), T.StructField("c", T.LongType())])
    given = {1: "12", 2: "-5,9E+2", 3: "1.5", 4: "99999999999999999999", 5: "1e30", 6: "'a''b'", 7: "NULL", 8: "'7'", 9: "Yes"}
    lines = spark.createDataFrame([(f"INSERT INTO t VALUES ({k}, {v});",) for k, v in given.items()], "value string")
    rows = parse_insert_dump(lines, schema, float_longs=("c",)).toDF("text", "no", "id", "c", "reason").collect()
    assert {r.id: (r.c, r.reason) for r in rows} == {
        1: (12, None), 2: (-590, None), 3: (1, None), 4: (None, "bad c"), 5: (None, "bad c"), 6: (None, "bad c"),
        7: (None, None), 8: (7, None), 9: (None, "bad c")}


def test_plain_and_odd_spacing_give_the_same(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    given = {"(1, 'x');": [(1, "x", None)], "(1,'x') , ( 2 , 'y, (z); ''w' ) ;": [(1, "x", None), (2, "y, (z); 'w", None)],
             "(1, 'x'), (2, 'y');": [(1, "x", None), (2, "y", None)], "();": [(None, None, "text between the values")],
             "(1, 'x' 'y');": [(1, "x", "text between the values")], "(1, 'x') extra);": [(None, None, "text outside the value tuples")],
             "(1, 'x'), (2, 3,5E0);": [(1, "x", None), (2, "3.5E0", None)], "(1, 2,5);": [(1, "2", "expected 2 values, got 3")],
             "(1, 'x'":  [(None, None, "statement does not end with ');'")]}
    for text, rows in given.items():
        lines = spark.createDataFrame([(f"INSERT INTO t VALUES {text}",)], "value string")
        found = parse_insert_dump(lines, schema, float_longs=()).orderBy("tuple_no").collect()
        assert [(r.a, r.b, r.reject_reason) for r in found] == rows, text


def test_a_plain_line_is_cut_at_its_separators(spark):
    lines = spark.createDataFrame([("INSERT INTO t VALUES (1, 'x', 2,5E0, NULL);",)], "value string")
    plan = parse_insert_dump(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan


def test_plain_lines_read_as_the_general_pattern_reads_them(spark):
    """A line with one more blank before its end is read by the general pattern; both must agree."""
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType()), T.StructField("c", T.IntegerType())])
    tuples = ["1, 'x', 2", "-1.5, 'a b', NULL", "1,5E3, 'y', -7", "NULL, NULL, NULL", "1, 'NULL', 2", "1, null, 2", "1, Null, 2",
              "1, nullx, 2", "1, NULLx, 2", "NULLx, 'x', 1", "-NULL, -Yes, 1", "1, Yes, 2", "1, '', 2", "'', '', ''", "1, 'NULLs', 2",
              "1, 'a, b', 2", "1, 'it''s', 2", r"1, 'c:\d', 2", r"1, 'it\'s', 2", "1, 'a\x01b', 2", "'7', 'x', '8'", "1, 2,5, 3",
              ".5, 'x', -.5", "1e3, 'x', 1E3", "1,5, 'x'", "1, 'x'", "1, 'x', 2, 3", "x, 'x', 99999999999", "1, 'é\u00a0ü, ', 2",
              "1, '(x);', 2", "1,'x',2", "1 'x' 2", "NaN, 'x', 1", "1, 'x\ty', 2", "1, 'x', NULL", "NULL"]
    for head in ("INSERT INTO t VALUES (", "insert into t values (", "INSERT INTO VALUES VALUES (", "INSERT INTO a_values VALUES ("):
        pairs = [(i, f"{head}{t});", f"{head}{t}) ;") for i, t in enumerate(tuples)]
        def read(column):
            lines = spark.createDataFrame(pairs, "i int, plain string, other string")
            rows = parse_insert_dump(lines, schema, line_col=column, float_longs=()).collect()
            return {" ".join(r.line.rsplit(")", 1)[0].split()): (r.tuple_no, str(r.a), r.b, r.c, r.reject_reason) for r in rows}
        assert read("plain") == read("other")
