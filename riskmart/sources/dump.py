"""SQL-dump source (S4–S6, P12, P13, P25): ``INSERT INTO … VALUES (…);`` lines → rows.

The whole parse is one Catalyst projection over ``spark.read.text`` (regex
extract, regex find-all, array transform, ``try_cast``): no Python worker, no
RDD, and the text splits across tasks like any other file.

Two tokenizer modes:

* ``strict`` keeps the reference's rules: one statement per line, the text
  between ``VALUES (`` and the last ``);`` is cut into quoted strings and
  numbers; anything else (barewords such as ``NULL`` or ``Yes``) is skipped, so a
  decimal-comma number splits in two and later values shift.
* ``locale`` reads every ``(…)`` tuple of the line, keeps decimal-comma numbers
  whole, unescapes ``''``, reads ``NULL`` as null and keeps other barewords. A
  decimal comma is recognised in exponent form only (``5,85916E+11``): a bare
  ``19,9`` stays two values, as ``(1,2)`` is two values in ordinary dumps.

A line or tuple that fails (wrong value count, a value that does not fit its
type, no ``VALUES``/``;``) is not dropped silently: it goes to the rejects with
a reason. In ``locale`` mode a line must be nothing but tuples and a tuple nothing
but values, so every tuple is either accepted or rejected, alone or with its line.
Inside quotes ``''`` and ``\\'`` are a quote and ``\\\\`` is a backslash; any other
backslash is itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sources.records import sql_statements

# The tokenizer patterns. STRICT_* mirror the reference's parser;
# LOCALE_* are this package's own reading of the same statements.
INSERT_LINE = r"^\s*(?i:INSERT INTO)"
STRICT_VALUES = r"(?is)VALUES\s*\((.+)\)\s*;"
STRICT_TOKEN = r"'[^']*'|-?[\d.]+(?:[Ee][+\-]?\d+)?"
LOCALE_VALUES = r"(?is)\bVALUES\b(.*)$"
LOCALE_END = r"\)\s*;\s*$"
# Possessive quantifiers: a token never needs to give characters back, so the
# matcher does not backtrack character by character.
_QUOTED = r"'(?:[^'\\]++|''|\\.)*+'"
LOCALE_TUPLE = rf"(?s)\((?:{_QUOTED}|[^'()]++)*+\)"
_EXPONENT = r"[Ee][+-]?[0-9]++"
LOCALE_TOKEN = (rf"{_QUOTED}|-?[0-9]++(?:\.[0-9]++(?:{_EXPONENT})?|,[0-9]++{_EXPONENT}|{_EXPONENT})?"
                r"|-?\.[0-9]++|-?[A-Za-z_]++")
# A line is read only if it is nothing but tuples, and a tuple only if it is nothing but values.
_TUPLE = LOCALE_TUPLE.removeprefix("(?s)")
LOCALE_BODY = rf"(?s)^\s*+{_TUPLE}(?:\s*+,\s*+{_TUPLE})*+\s*+;\s*+$"
LOCALE_WHOLE = rf"(?s)^\(\s*+(?:{LOCALE_TOKEN})(?:\s*+,\s*+(?:{LOCALE_TOKEN}))*+\s*+\)$"
# The common line: one tuple, ", " between values, quoted text without quotes, backslashes or commas,
# nulls written NULL. Its values are cut at the separators; _CUT occurs in no such line.
_CUT = "\u0001"
_PLAIN = (rf"(?:'(?!NULL')[^'\\,{_CUT}\n\r]*+'|-?[0-9]++(?:\.[0-9]++(?:{_EXPONENT})?|,[0-9]++{_EXPONENT}|{_EXPONENT})?"
          r"|-?\.[0-9]++|NULL|-?(?!(?i:null)[,)])[A-Za-z_]++)")
LOCALE_PLAIN = rf"^(?i:INSERT INTO) (?!(?i:VALUES) )[A-Za-z0-9_]++ (?i:VALUES) \(({_PLAIN}(?:, {_PLAIN})*+)\);\z"

# The 18 columns of the economics dump, in file order. Floats are
# read as double (the reference's 32-bit floats lose digits: 19.9 → 19.8999996)
# and the id as a 64-bit integer; curation narrows it when asked to.
ECONOMICS_DUMP_SCHEMA = T.StructType([
    T.StructField("Conflict_Id", T.LongType()),
    T.StructField("Pre_War_Unemployment_pct", T.DoubleType()),
    T.StructField("During_War_Unemployment_pct", T.DoubleType()),
    T.StructField("Unemployment_Spike_pp", T.DoubleType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Youth_Unemployment_Change_pct", T.DoubleType()),
    T.StructField("Pre_War_Poverty_Rate_pct", T.DoubleType()),
    T.StructField("During_War_Poverty_Rate_pct", T.DoubleType()),
    T.StructField("Extreme_Poverty_Rate_pct", T.DoubleType()),
    T.StructField("Food_Insecurity_Rate_pct", T.DoubleType()),
    T.StructField("Households_Fallen_Into_Poverty", T.IntegerType()),
    T.StructField("GDP_Change_pct", T.DoubleType()),
    T.StructField("Inflation_Rate_pct", T.DoubleType()),
    T.StructField("Currency_Devaluation_pct", T.DoubleType()),
    T.StructField("Estimated_Reconstruction_Cost_USD", T.LongType()),
    T.StructField("Informal_Economy_Pre_War_pct", T.DoubleType()),
    T.StructField("Informal_Economy_During_War_pct", T.DoubleType()),
    T.StructField("War_Profiteering_Documented", T.StringType()),
])
# Fixed value: the whole-number column that the reference reads through a float.
FLOAT_LONGS = ("Estimated_Reconstruction_Cost_USD",)


@dataclass
class DumpRead:
    rows: DataFrame
    rejects: DataFrame

    def __iter__(self):
        return iter((self.rows, self.rejects))


def _typed(value: Column, field: T.StructField, float_longs: tuple[str, ...]) -> Column:
    if isinstance(field.dataType, T.StringType):
        return value
    if field.name in float_longs:
        # written as a float ("5.85916E+11"): parse, then truncate. A value with a point or an
        # exponent is no whole number: a failing cast costs an exception for every row.
        whole = ~(value.contains(".") | value.contains("E") | value.contains("e"))
        return F.coalesce(F.when(whole, value.try_cast("long")), value.try_cast("double").try_cast("long"))
    return value.try_cast(field.dataType)


def _strip_quotes(t: Column) -> Column:
    return F.when(t.startswith("'"), t.substr(F.lit(2), F.length(t) - 2)).otherwise(t)


def _locale_token(t: Column) -> Column:
    # The tokenizer only yields quoted strings, numbers ([0-9.,eE+-]) and
    # barewords, so a comma can only be a decimal comma.
    inner = t.substr(F.lit(2), F.length(t) - 2)
    escaped = inner.contains("'") | inner.contains("\\")
    return (F.when(t.startswith("'"), F.when(escaped, F.regexp_replace(inner, r"['\\](['\\])", "$1")).otherwise(inner))
            .when((F.length(t) == 4) & (F.upper(t) == "NULL"), F.lit(None).cast("string"))
            .otherwise(F.replace(t, F.lit(","), F.lit("."))))


def _plain_values(body: Column) -> Column:
    """The values of a plain line's tuple, as ``_locale_token`` gives them; a comma left in one is a decimal comma."""
    def replaced(text: Column, old: str, new: str) -> Column:
        return F.replace(text, F.lit(old), F.lit(new))
    cut = F.split(replaced(replaced(replaced(body, ", ", _CUT), ",", "."), "'", ""), _CUT)
    return F.when(body.contains("NULL"), F.transform(cut, lambda t: F.nullif(t, F.lit("NULL")))).otherwise(cut)


def parse_insert_dump(lines: DataFrame, schema: T.StructType = ECONOMICS_DUMP_SCHEMA,
                      mode: str = "locale", line_col: str = "value",
                      float_longs: tuple[str, ...] = FLOAT_LONGS) -> DataFrame:
    """Parse INSERT lines into typed columns plus ``line``, ``tuple_no``, ``reject_reason``.

    ``reject_reason`` is null for a good row. Lines that are not INSERT
    statements are skipped (they are DDL, comments, blank lines). Each regex runs
    once per line (staged projections). The clean-up is one expression over the
    array of values, and a value is cast once: written out for every column they make
    a generated method so long that the JVM does not compile it.
    """
    n = len(schema.fields)
    line = F.col("line")
    ins = lines.select(F.col(line_col).alias("line")).filter(line.startswith("INSERT INTO") | line.rlike(INSERT_LINE))
    if mode == "strict":
        body = ins.select("line", F.regexp_extract("line", STRICT_VALUES, 1).alias("_body"))
        staged = body.select(
            "line", F.lit(0).alias("tuple_no"),
            F.regexp_extract_all("_body", F.lit(STRICT_TOKEN), 0).alias("_raw"),
            F.when(F.col("_body") == "", F.lit("no VALUES (...); clause")).alias("_shape")).select(
            "line", "tuple_no", "_shape", F.transform("_raw", _strip_quotes).alias("_values"))
    elif mode == "locale":
        known = ins.select("line", F.nullif(F.regexp_extract("line", LOCALE_PLAIN, 1), F.lit("")).alias("_plain"))
        # null for a plain line, so nothing below looks at its text
        other = F.when(F.col("_plain").isNull(), F.col("line"))
        after = known.select("line", "_plain", F.regexp_extract(other, LOCALE_VALUES, 1).alias("_after"),
                             (other.endswith(");") | other.rlike(LOCALE_END)).alias("_ends"))
        tuples = after.select("line", "_plain", "_after", "_ends",
                              F.regexp_extract_all("_after", F.lit(LOCALE_TUPLE), 0).alias("_tuples"))
        # Tuples and values that make up the text as it is commonly written need no second pattern.
        plain_body = F.col("_after") == F.concat(F.lit(" "), F.array_join("_tuples", ", "), F.lit(";"))
        plain_tuple = (F.size("_raw") > 0) & (F.col("_tuple") == F.concat(F.lit("("), F.array_join("_raw", ", "), F.lit(")")))
        shape = (F.when(F.col("_after") == "", F.lit("no VALUES clause"))
                 .when(~F.col("_ends"), F.lit("statement does not end with ');'"))
                 .when(F.size("_tuples") == 0, F.lit("no value tuple"))
                 .when(~(plain_body | F.col("_after").rlike(LOCALE_BODY)), F.lit("text outside the value tuples")))
        is_plain = F.col("_plain").isNotNull()
        found = F.when(is_plain, F.array("_plain")).when(F.col("_line").isNull(), F.col("_tuples"))
        exploded = tuples.select("line", "_plain", "_tuples", F.when(~is_plain, shape).alias("_line")).select(
            "line", is_plain.alias("_plain"), "_line", F.posexplode_outer(found).alias("tuple_no", "_tuple"))
        whole = F.col("_plain") | plain_tuple | F.col("_tuple").rlike(LOCALE_WHOLE)
        staged = exploded.select(
            "line", "tuple_no", "_plain", "_line", "_tuple",
            F.regexp_extract_all(F.when(~F.col("_plain"), F.col("_tuple")), F.lit(LOCALE_TOKEN), 0).alias("_raw")).select(
            "line", "tuple_no", F.coalesce("_line", F.when(~whole, F.lit("text between the values"))).alias("_shape"),
            F.when(F.col("_plain"), _plain_values(F.col("_tuple"))).otherwise(F.transform("_raw", _locale_token)).alias("_values"))
    else:
        raise ValueError(f"unknown dump mode {mode!r}")

    values = staged.select("line", "tuple_no", "_shape", "_values")
    columns = [_typed(F.get("_values", i), f, float_longs).alias(f"_c{i}") for i, f in enumerate(schema.fields)]
    typed = values.select("line", "tuple_no", "_shape", "_values", *columns)
    failures = [F.when(F.get("_values", i).isNotNull() & F.col(f"_c{i}").isNull(), F.lit(f"bad {f.name}"))
                for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
    count = F.size("_values")
    reason = F.coalesce(
        F.col("_shape"),
        F.when(count != n, F.format_string(f"expected {n} values, got %d", count)),
        *failures)
    return typed.select("line", "tuple_no", *[F.col(f"_c{i}").alias(f.name) for i, f in enumerate(schema.fields)],
                        reason.alias("reject_reason"))


def split_parsed(parsed: DataFrame, schema: T.StructType = ECONOMICS_DUMP_SCHEMA) -> DumpRead:
    names = [f"`{f.name}`" for f in schema.fields]
    rows = parsed.filter(F.col("reject_reason").isNull()).select(*names)
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select(
        "line", "tuple_no", F.col("reject_reason").alias("reason"))
    return DumpRead(rows, rejects)


def read_insert_dump(spark: SparkSession, path: str, schema: T.StructType = ECONOMICS_DUMP_SCHEMA,
                     mode: str = "locale", statements: bool = False) -> DumpRead:
    """Read a dump file set → ``(rows, rejects)``; both lazy.

    ``statements`` reads statements and quoted values over several lines (``records.sql_statements``,
    which stores the lines once); without it a line is a statement.
    """
    lines = sql_statements(spark, path) if statements else spark.read.text(path)
    return split_parsed(parse_insert_dump(lines, schema, mode), schema)


def insert_lines(df: DataFrame, table: str, decimal_comma: tuple[str, ...] = (),
                 barewords: tuple[str, ...] = ()) -> DataFrame:
    """Render rows as one ``INSERT INTO table VALUES (…);`` line each (``value`` column).

    Strings are quoted with ``''`` and ``\\\\`` escaping (unquoted for ``barewords``), nulls
    become ``NULL``; listed numeric columns are written with a decimal comma.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in barewords:
            text = c.cast("string")
        elif isinstance(f.dataType, T.StringType):
            text = F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")),
                            F.lit("'"))
        else:
            text = c.cast("string")
            if f.name in decimal_comma:
                # Exponent form ("19,9E0"): a bare "19,9" would read as two values.
                text = F.when(text.rlike(r"^-?[0-9.]+$"), F.concat(text, F.lit("E0"))).otherwise(text)
                text = F.translate(text, ".", ",")
        parts.append(F.coalesce(text, F.lit("NULL")))
    return df.select(F.concat(F.lit(f"INSERT INTO {table} VALUES ("), F.concat_ws(", ", *parts),
                              F.lit(");")).alias("value"))
