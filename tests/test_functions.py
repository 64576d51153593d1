from pyspark.sql import functions as F

from riskmart.functions.columns import parse_locale_double, sanitize_floats, typed_null, weighted_score
from riskmart.operators.harmonise import (flat_feed, nested_feed, replicate, union_feeds,
                                          union_positional, TARGET_SCHEMA)
from riskmart.operators.text import word_count


def test_locale_double(spark):
    df = spark.createDataFrame([("1,06957E+11",), ("71321188262",), ("",), ("abc",), (" 2,5 ",)], "s string")
    assert [r[0] for r in df.select(parse_locale_double("s")).collect()] == \
        [106957000000.0, 71321188262.0, None, None, 2.5]


def test_weighted_score_left_to_right(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.3)], "a double, b double, c double")
    got = df.select(weighted_score([("a", 0.3), ("b", 0.2), ("c", 0.1)])).first()[0]
    assert got == (0.1 * 0.3 + 0.2 * 0.2) + 0.3 * 0.1
    assert df.select(weighted_score([("a", 1.0), (F.lit(None).cast("double"), 1.0)])).first()[0] is None


def test_sanitize_only_floats(spark):
    df = spark.createDataFrame([(1, float("-inf"), "x")], "i int, d double, s string")
    assert sanitize_floats(df).first() == (1, None, "x")


def test_typed_null_union_keeps_type(spark):
    a = spark.range(1).select(typed_null("string").alias("x"))
    b = spark.createDataFrame([("v",)], "x string")
    assert dict(a.unionByName(b).dtypes)["x"] == "string"


def test_harmonise_feeds(spark):
    flat = spark.createDataFrame(
        [(1, "A", "1 Main", None, "Raleigh", "NC", 27601, "555", "2020-01-01", "Restaurant",
          -78.6, 35.7, 9, 9, "M"),
         (2, "B", "2 Main", "Ste 1", "Cary", None, 27511, "556", "2021-01-01", "Food Stand",
          -78.7, 35.8, 9, 9, "M")],
        "HSISID long, NAME string, ADDRESS1 string, ADDRESS2 string, CITY string, STATE string, "
        "POSTALCODE int, PHONENUMBER string, RESTAURANTOPENDATE string, FACILITYTYPE string, "
        "X double, Y double, OBJECTID long, PERMITID long, GEOCODESTATUS string")
    nested = spark.createDataFrame(
        [(("56060", "C", "3 Elm", None, "Durham", "NC", "27701", "557", "1999-01-01", None,
           "1 - Restaurant", [35.9, -78.9]), None, "t", "r1"),
         (("56061", "D", "4 Elm", None, "Durham", "NC", "27702", "558", "1999-02-01", "2001-01-01",
           "Restaurant", []), None, "t", "r2")],
        "fields struct<id string, premise_name string, premise_address1 string, "
        "premise_address2 string, premise_city string, premise_state string, premise_zip string, "
        "premise_phone string, opening_date string, closing_date string, type_description string, "
        "geolocation array<double>>, geometry string, record_timestamp string, recordid string")
    out = union_feeds([flat_feed(flat, "Wake"), nested_feed(nested, "Durham")])
    assert out.columns == [f.name for f in TARGET_SCHEMA.fields]
    rows = {r.datasetId: r for r in out.collect()}
    assert rows["1"].id == "NC_Wake_1" and rows["2"].id is None      # null state → null id
    assert rows["56060"].type == "Restaurant" and rows["56061"].type is None
    assert rows["56060"].geoX == 35.9 and rows["56061"].geoX is None
    assert rows["1"].dateEnd is None and rows["56061"].dateEnd == "2001-01-01"


def test_positional_union_and_replicate(spark):
    a = spark.createDataFrame([(1, "x")], "k long, n string")
    b = spark.createDataFrame([(2, "y")], "other long, name string")
    assert union_positional([a, b]).columns == ["k", "n"]
    assert replicate(a, 61).count() == 61


def test_word_count_tokens(spark):
    lines = spark.createDataFrame([("",), ("  Hello   world\t hello",), ("world, World!\r\n",)],
                                  "text string")
    got = {r.word: r.n for r in word_count(lines).collect()}
    assert got == {"Hello": 1, "world": 1, "hello": 1, "world,": 1, "World!": 1}


def test_interval_columns(spark):
    from riskmart.operators.harmonise import interval_columns
    df = spark.createDataFrame([(1.0, 3.0), (None, 2.0)], "lcl double, ucl double")
    out = interval_columns(df)
    assert out.columns == ["lcl", "ucl", "avg", "lcl2", "ucl2"]
    assert [r.avg for r in out.collect()] == [2.0, None]
