"""Column builders: Java split/trim semantics, int parsing, dates."""

from pyspark.sql import functions as F

from tessera.functions import (
    date_label, java_split, java_trim, parse_date_time, parse_hms, parse_ymd, split_lines, to_int,
)


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


# What java.lang.String.split returns for these inputs (worked out by hand from
# the Pattern.split contract: leading empties kept, trailing empties dropped).
SPLIT_CASES = [
    (r"\W+", "", [""]),
    (r"\W+", "---", []),
    (r"\W+", "--x--", ["", "x"]),
    (r"\W+", "a a, a", ["a", "a", "a"]),
    (r"\W+", "don't stop", ["don", "t", "stop"]),
    (r"\W+", "été", ["", "t"]),
    (r"[^\w']", "don't  stop", ["don't", "", "stop"]),
    (r"[^\w']", "a--", ["a"]),
    (r"[^\w']", "-a", ["", "a"]),
    (r"\s*,\s*", "1, 2 ,3,,", ["1", "2", "3"]),
    ("::", "1::2::3", ["1", "2", "3"]),
    ("::", "a:::", ["a", ":"]),
    (" ", "a  b ", ["a", "", "b"]),
    (r"\s+", " 1 2", ["", "1", "2"]),
]


def test_java_split(spark):
    for pat, s, want in SPLIT_CASES:
        got = one(spark, lambda c: java_split(c, pat), s)
        assert got == want, (pat, s, got, want)


def test_java_split_drop_empty(spark):
    assert one(spark, lambda c: java_split(c, r"\W+", drop_empty=True), "--x--y") == ["x", "y"]


def test_java_trim(spark):
    assert one(spark, java_trim, "\t\n  a b \r\x01") == "a b"
    assert one(spark, F.trim, "\ta ") == "\ta"   # Spark's trim is not Java's


def test_to_int(spark):
    cases = {"12": 12, " 7 ": 7, "+5": 5, "-3": -3, "NA": -1, "": -1, "5.0": -1, "1e3": -1,
             "99999999999": -1, "x": -1}
    for s, want in cases.items():
        assert one(spark, to_int, s) == want, s
    assert one(spark, lambda c: to_int(c, None), "NA") is None


def test_dates(spark):
    assert one(spark, parse_ymd, "01/02/2008").asDict() == {"year": 2008, "month": 1, "day": 2}
    assert one(spark, parse_ymd, "1-2-2008").asDict() == {"year": 2008, "month": 1, "day": 2}
    assert one(spark, parse_ymd, "01/02") is None
    assert one(spark, parse_ymd, "ab/cd/efgh") is None
    assert one(spark, parse_hms, "12:30").asDict() == {"hour": 12, "minute": 30, "second": 0}
    assert one(spark, parse_hms, "12:30:15").asDict() == {"hour": 12, "minute": 30, "second": 15}
    assert one(spark, parse_hms, "abc") is None
    d = one(spark, parse_date_time, "01/02/2008 12:30")
    assert d["ymd"]["year"] == 2008 and d["hms"]["minute"] == 30
    assert one(spark, parse_date_time, "01/02/2008 12:30 x") is None
    assert one(spark, parse_date_time, "01/02 2008 12:30") is None


def test_date_label(spark):
    df = spark.createDataFrame([(2008, 1, 3, 4)], "y int, m int, d int, w int")
    assert df.select(date_label("y", "m", "d", "w")).first()[0] == "2008-01-03 (Thursday)"


def test_split_lines(spark):
    assert one(spark, split_lines, "a\nb\r\nc\rd\n") == ["a", "b", "c", "d"]
    assert one(spark, split_lines, "a\n\n") == ["a", ""]
    assert one(spark, split_lines, "") == []
