import datetime

import pytest

from tierflow.functions import text


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def parse(request, spark):
    """Value of an expression over one text column ``v``, with ANSI mode on and off."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)

    def run(expression, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in df.orderBy("i").selectExpr(f"{expression} AS x").collect()]

    yield run
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_clean_column_name():
    assert text.clean_column_name("  Passing Yards/Game (avg)  ") == "passing_yardsgame_avg"
    assert text.clean_column_name("TD's %") == "tds_"


def test_lenient_int(parse):
    values = ["12", " 12 ", "12.7", "-12.7", ".5", "5.", "1e3", "", "--", "abc", "+4", "12.x", None]
    assert parse(text.lenient_int("v"), values) == [
        12, 12, 12, -12, 0, 5, None, None, None, None, 4, None, None,
    ]


def test_int_range(parse):
    values = ["2147483647", "2147483648", "-2147483648", "99999999999", "99999999999.5"]
    assert parse(text.lenient_int("v"), values) == [2147483647, None, -2147483648, None, None]


def test_lenient_int_is_the_legacy_cast(spark):
    values = ["7", "07", "7.", "7.9", "-7.9", "+7", "7 ", "\t7", "x7", "7x", "1 2", "1e2", "--7", "-"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.selectExpr("v", "cast(v as int) a", f"{text.lenient_int('v')} b").collect()
    spark.conf.set("spark.sql.ansi.enabled", before)
    assert [(r.v, r.a) for r in found] == [(r.v, r.b) for r in found]


def test_lenient_float_is_the_legacy_cast(spark):
    values = ["1", "1.5", ".5", "5.", "1e3", "-2E-1", "1.5f", "1.5d", "NaN", "inf", "-Infinity",
              "1,234.5", "n/a", "--", "", " 3 ", "1e", "0x1p3", "+.5", "."]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.selectExpr("v", "cast(cast(v as float) as string) a",
                          f"cast({text.lenient_float('v')} as string) b").collect()
    spark.conf.set("spark.sql.ansi.enabled", before)
    assert [(r.v, r.a) for r in found] == [(r.v, r.b) for r in found]


def test_comma_and_marker_and_digits(parse):
    assert parse(text.comma_int("v"), ["1,234", "1,2,3", "1,234.9", ","]) == [1234, 123, 1234, None]
    assert parse(text.marker_int("v"), ["85T", "T85", "85", "TT", "85t"]) == [85, 85, 85, None, None]
    assert parse(text.digits_int("v"), ["45*", "12.5", "1,000", "-3", "12-3", "", "--", "+5"]) == [
        45, 125, 1000, -3, None, None, None, 5,
    ]


def test_extract_key(parse):
    values = ["fred/123", "a/b/123", "123", "abc", "x/", None, "a b/ 12"]
    assert parse(text.extract_key("v"), values) == [123, 123, 123, None, None, None, 12]


def test_pairs(parse):
    last, first = text.split_pair("v")
    values = ["Evans, Fred", "Evans,Fred", "A, B, C", "Solo", None, ", Fred"]
    assert parse(last, values) == ["Evans", "Evans,Fred", "A", "Solo", None, ""]
    assert parse(first, values) == ["Fred", None, "B", None, None, "Fred"]
    assert parse(text.has_pair("v"), values) == [True, False, True, False, None, True]
    last, first = text.split_pair("v", text.LENIENT_PAIR)
    assert parse(last, ["A,B", "A,   B", "A"]) == ["A", "A", "A"]
    assert parse(first, ["A,B", "A,   B", "A"]) == ["B", "B", None]


def test_parse_date(parse):
    values = ["4/5/1982", "04/15/1982", "4/5/82", "13/45/1990", "2/30/1985", "not-a-date", None]
    assert parse(text.parse_date("v"), values) == [
        datetime.date(1982, 4, 5), datetime.date(1982, 4, 15), None, None, None, None, None,
    ]


def test_normalise(parse):
    values = ["  a ", " ", "", "--", " -- ", "\t", None]
    assert parse(text.normalise("v"), values) == ["a", None, None, "--", "--", "\t", None]
    assert parse(text.normalise("v", zero=True), values) == ["a", None, None, "0", "0", "\t", None]
