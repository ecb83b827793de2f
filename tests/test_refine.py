import datetime

import pytest

from conftest import bag
from tierflow.operators import (
    blanks_to_null,
    first_per_key,
    normalise_header,
    refine,
    replace_dashes,
    safe_float,
    safe_int,
    trim_all,
)
from tierflow.operators.refine import distinct_texts
from tierflow.schemas import RAW_COLUMNS, raw_schema
from tierflow.specs import FULL, clean_spec


def cleaned(rows, category, columns, data, mode="full", **options):
    df = rows(data, ", ".join(f"{c} string" for c in columns.split()))
    options.setdefault("missing", "skip")
    return refine(df, clean_spec(category, mode), **options).collect()


def raw_row(category, **values):
    return tuple(values.get(c) for c in RAW_COLUMNS[category])


# Category, columns, input rows, expected rows as dicts of the checked columns. Each case is made
# from one rule: the value that just passes a test beside the one that just fails it.
CASES = [
    # keys behind any prefix, names split once
    ("rushing", "player_id name rushing_yards",
     [("a/b/c/40", "Quill, Ada", "1000"), ("41", "Quill, Ada, Jr", "1000")],
     [{"player_id": 40, "last_name": "Quill", "first_name": "Ada"},
      {"player_id": 41, "first_name": "Ada"}]),
    ("rushing", "player_id name rushing_yards", [("k/", "Quill, Ada", "1000")],
     [{"player_id": None}]),
    # the strict separator needs its blank, the lenient one doesn't
    ("rushing", "player_id name rushing_yards", [("7", "Quill,Ada", "1000")], []),
    ("players", "player_id name birthday birth_place",
     [("7", "Quill,Ada", "3/9/1971", "Upper Mill,   OX")],
     [{"first_name": "Ada", "birth_city": "Upper Mill", "birth_state": "OX",
       "birthday": datetime.date(1971, 3, 9)}]),
    ("players", "player_id name birthday birth_place", [("7", "Quill", "11/30/2001", "Mill")],
     [{"first_name": None, "last_name": "Quill", "birth_state": None}]),
    # thresholds
    ("passing", "player_id name passing_yards",
     [("1", "L, M", "999"), ("2", "L, M", "1000"), ("3", "L, M", "999.9")], [{"player_id": 2}]),
    ("receiving", "player_id name receiving_yards",
     [("1", "L, M", "0,999"), ("2", "L, M", "1,000")], [{"receiving_yards": 1000}]),
    ("kicking", "player_id name fgs_made", [("1", "L, M", "19"), ("2", "L, M", "20")],
     [{"fgs_made": 20}]),
    ("returns", "player_id name kick_returns_for_tds punt_returns_for_tds",
     [("1", "L, M", "0", "9"), ("2", "L, M", "9", "0"), ("3", "L, M", "1", "1")],
     [{"player_id": 3}]),
    ("returns", "player_id name punt_returns_for_tds", [("4", "L, M", "1"), ("5", "L, M", "--")],
     [{"player_id": 4}]),
    ("defensive", "player_id name total_tackles sacks ints",
     [("1", "L, M", "99.5", "10", "5"), ("2", "L, M", "100", "0", "0"),
      ("3", "L, M", "0", "10.5", "0"), ("4", "L, M", "0", "0", "6")],
     [{"player_id": 2}, {"player_id": 3}, {"player_id": 4}]),
    ("defensive", "player_id name total_tackles solo_tackles", [("6", "L, M", "", "")], []),
    # the first year that counts
    ("rushing", "player_id name rushing_yards year",
     [("1", "L, M", "1000", "1969"), ("2", "L, M", "1000", "1970"), ("3", "L, M", "1000", "--")],
     [{"player_id": 2, "year": "1970"}]),
    ("kicking", "player_id name fgs_made year", [("1", "L, M", "20", "1969.9")], []),
    # numbers: commas and fractions, not exponents; digits alone; a marker
    ("rushing", "player_id name rushing_yards rushing_tds fumbles",
     [("1", "L, M", "1,000.75", "2e1", "x")],
     [{"rushing_yards": 1000, "rushing_tds": None, "fumbles": None}]),
    ("kicking", "player_id name fgs_made longest_fg_made extra_points_made",
     [("1", "L, M", "2 0", "5.5", "31 of 33")],
     [{"fgs_made": 20, "longest_fg_made": 55, "extra_points_made": 3133}]),
    ("receiving", "player_id name receiving_yards longest_reception",
     [("1", "L, M", "1000", "T61"), ("2", "L, M", "1000", "6T1T")],
     [{"longest_reception": 61}, {"longest_reception": 61}]),
    ("passing", "player_id name passing_yards completion_percentage",
     [("1", "L, M", "1000", "61.25"), ("2", "L, M", "1000", "1,061.25")],
     [{"completion_percentage": 61.25}, {"completion_percentage": None}]),
    # dates: four digits of the year, and a day that exists
    ("players", "player_id name birthday", [("1", "L,M", "3/9/71"), ("2", "L,M", "2/29/1971"),
     ("3", "L,M", "2/29/1972"), ("4", "L,M", "soon"), ("5", "L,M", "1972-02-29")],
     [{"player_id": 3, "birthday": datetime.date(1972, 2, 29)}]),
    # columns that are absent are not tested
    ("passing", "player_id name", [("8", "L, M")], [{"player_id": 8, "last_name": "L"}]),
    ("defensive", "player_id name", [("9", "L, M")], [{"first_name": "M"}]),
]


@pytest.mark.parametrize("category, columns, data, expected", CASES)
def test_cases(rows, category, columns, data, expected):
    found = [r.asDict() for r in cleaned(rows, category, columns, data)]
    found.sort(key=lambda r: r["player_id"] or 0)
    assert [{k: r[k] for k in e} for r, e in zip(found, expected)] == expected
    assert len(found) == len(expected)


def test_missing_columns(rows):
    data = [("k/8", "L, Jim")]
    found = cleaned(rows, "passing", "player_id name", data, missing="null")
    assert found[0].passing_yards is None and found[0].first_name == "Jim"
    assert list(found[0].asDict()) == FULL["passing"].silver_schema().names
    with pytest.raises(ValueError, match="passing_yards"):
        cleaned(rows, "passing", "player_id name", data, missing="error")
    with pytest.raises(ValueError):
        cleaned(rows, "passing", "player_id name", data, missing="other")


def test_keep_null_measures(rows):
    data = [("id/1", "A, B", None), ("id/2", "A, B", "5"), ("id/3", "A, B", "1000")]
    kept = cleaned(rows, "passing", "player_id name passing_yards", data, keep_null_measures=True)
    assert sorted(r.player_id for r in kept) == [1, 3]


def test_defensive_modes(rows):
    columns, data = "player_id name total_tackles sacks ints", [("1", "A, B", "50", "12", None)]
    assert len(cleaned(rows, "defensive", columns, data)) == 1
    assert cleaned(rows, "defensive", columns, data, mode="incremental") == []
    null_test = [("1", "A, B", None, None, "6"), ("2", "A, B", None, None, "5")]
    assert [r.player_id for r in cleaned(rows, "defensive", columns, null_test)] == [1]


def test_placeholder_before_and_after_dedup(rows):
    data = [("id/1", "A, B", "2000", "--"), ("id/1", "A, B", "2000", "0")]
    merged = cleaned(rows, "rushing", "player_id name rushing_yards fumbles", data)
    assert [r.fumbles for r in merged] == [0]
    apart = cleaned(rows, "passing", "player_id name passing_yards ints", data)
    assert [r.ints for r in apart] == [0, 0]


def test_dedup_only_where_the_rules_say(rows):
    data = [("id/1", "A, B", " 2000"), ("id/1", "A, B", "2000 ")]
    assert len(cleaned(rows, "receiving", "player_id name receiving_yards", data)) == 2
    assert len(cleaned(rows, "kicking", "player_id name fgs_made", data)) == 2
    assert len(cleaned(rows, "rushing", "player_id name rushing_yards", data)) == 1


@pytest.mark.parametrize("category", list(RAW_COLUMNS))
def test_silver_schema(spark, category):
    empty = spark.createDataFrame([], raw_schema(category))
    found = refine(empty, clean_spec(category)).schema
    expected = FULL[category].silver_schema()
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in expected]


def test_players_dedup_keeps_the_first_row(spark):
    values = {"birthday": "1/1/1990", "player_id": "x/1", "years_played": "3", "name": "A, B"}
    data = [raw_row("players", **values, college=c) for c in ("Yale", " Brown ", "Duke")]
    other = raw_row("players", **{**values, "years_played": "4"}, college="Rice")
    df = spark.createDataFrame([*data, other], raw_schema("players"))
    found = refine(df, clean_spec("players")).collect()
    assert sorted(r.college for r in found) == ["Brown", "Rice"]


def test_first_per_key_limits_before_the_shuffle(rows):
    df = rows([(1, "b"), (1, "a"), (2, None), (2, "c")], "k int, v string")
    one = first_per_key(df, ["k"])
    assert bag(one) == [(1, "a"), (2, None)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unknown_category():
    with pytest.raises(ValueError):
        clean_spec("punting")


def test_table_helpers(rows):
    df = rows([(" a ", "--", 1), ("", "1,234", 2)], "x string, y string, z int")

    def by_z(found):
        return [tuple(r)[:-1] for r in found.orderBy("z").collect()]

    assert by_z(trim_all(df)) == [("a", "--"), ("", "1,234")]
    assert by_z(replace_dashes(df)) == [(" a ", "0"), ("", "1,234")]
    assert by_z(replace_dashes(df, ["x"])) == by_z(df)
    assert by_z(blanks_to_null(df)) == [(" a ", "--"), (None, "1,234")]
    assert by_z(safe_int(df, ["y"])) == [(" a ", None), ("", 1234)]
    assert by_z(safe_float(df, ["y"])) == [(" a ", None), ("", None)]
    with pytest.raises(ValueError, match="w"):
        safe_int(df, ["w"])


def test_normalise_header(rows):
    df = rows([(1, 2)], "`Team Name` int, `lat.` int")
    assert normalise_header(df).columns == ["team_name", "lat"]
    with pytest.raises(ValueError, match="twice"):
        normalise_header(rows([(1, 2)], "`a b` int, `a_b` int"))
    with pytest.raises(ValueError, match="empty"):
        normalise_header(rows([(1,)], "`%` int"))


def test_distinct_texts_keep_marks_blanks_and_nulls(spark):
    """What joins the texts of a row, and what stands for NULL, may be in the texts themselves."""
    values = [None, "", "a", "\x01", "\x02", "\x03", "\x03a", "\x03b", "\x03c", "\x01\x03", "\x02\x03c", "é\x01"]
    rows = [(a, b, c) for a in values for b in values for c in (None, "x")]
    df = spark.createDataFrame(rows + rows[::-1], "a string, `b c` string, d string").repartition(3)
    found = distinct_texts(df)
    assert found.columns == ["a", "b c", "d"]
    assert bag(found) == bag(spark.createDataFrame(rows, df.schema))


def test_distinct_texts_keep_bytes_that_are_not_utf8(spark):
    df = spark.sql(
        "SELECT CAST(unhex(a) AS STRING) AS a, b FROM VALUES ('FF41', 'q'), ('FF41', 'q'), ('FE41', 'q'), "
        "('C3', NULL), ('C3', ''), ('0378', 'q') AS t(a, b)"
    )
    found = distinct_texts(df.repartition(3)).selectExpr("hex(a) AS a", "b")
    assert bag(found) == bag(df.selectExpr("hex(a) AS a", "b").distinct())


@pytest.mark.parametrize("category", ["passing", "rushing", "defensive", "returns"])
def test_deduplication_shuffles_one_text_a_row(spark, category):
    schema = raw_schema(category)
    numbers = {c: "2000" for c in RAW_COLUMNS[category]}
    full = tuple({**numbers, "name": "Quill, Ada", "team": " a\x01b "}.values())
    nulls = tuple({**dict.fromkeys(RAW_COLUMNS[category]), **{
        c: "2000" for c in ("year", "passing_yards", "rushing_yards", "total_tackles", "kick_returns_for_tds",
                            "punt_returns_for_tds") if c in numbers}, "name": "Quill, Ada"}.values())
    df = spark.createDataFrame([full, full, nulls, nulls, tuple(f" {v} " for v in full)], schema)
    found = refine(df, clean_spec(category))
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffles and all("hashpartitioning(_texts" in line for line in shuffles)
    assert sorted((r.team or "", r.player_id or 0) for r in found.collect()) == [("", 0), ("a\x01b", 2000)]
