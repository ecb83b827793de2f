"""What each category's cleaning keeps, parses and drops."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from tierflow.functions import text
from tierflow.schemas import RAW_COLUMNS

ALL = "all"
ROW = "row"


@dataclass(frozen=True)
class Pair:
    """Text column holding two parts, e.g. ``Last, First``."""

    source: str
    first: str
    second: str
    separator: str = text.STRICT_PAIR


@dataclass(frozen=True)
class Keep:
    """Row test over parsed columns; ``any_of`` joins its parts by OR instead of AND."""

    tests: tuple[tuple[str, str, int], ...]
    any_of: bool = False

    def condition(self, present, keep_null: bool = False) -> str | None:
        """SQL text of the tests whose column is present, or None if there is none."""
        parts = []
        for name, sign, bound in self.tests:
            if name in present:
                null = f" OR {name} IS NULL" if keep_null else ""
                parts.append(f"({name} {sign} {bound}{null})")
        return f"({(' OR ' if self.any_of else ' AND ').join(parts)})" if parts else None


@dataclass(frozen=True)
class CleanSpec:
    name: str
    zero_marks: str | tuple[str, ...] = ()
    zero_marks_after_dedup: bool = False
    dedup: str | tuple[str, ...] = ()
    pairs: tuple[Pair, ...] = (Pair("name", "last_name", "first_name"),)
    required: tuple[str, ...] = ("first_name",)
    ints: tuple[str, ...] = ()
    digit_ints: tuple[str, ...] = ()
    floats: tuple[str, ...] = ()
    marker_ints: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    keep: Keep | None = None
    year_floor: int | None = 1970
    dropped: tuple[str, ...] = ()
    key: str = "player_id"

    @property
    def raw_columns(self) -> tuple[str, ...]:
        return RAW_COLUMNS[self.name]

    def parsers(self) -> dict[str, tuple[Callable[[str], str], T.DataType]]:
        """Parser and result type of every column that does not stay text."""
        found = {self.key: (text.extract_key, T.IntegerType())}
        for names, parser, kind in (
            (self.ints, text.comma_int, T.IntegerType()),
            (self.digit_ints, text.digits_int, T.IntegerType()),
            (self.marker_ints, text.marker_int, T.IntegerType()),
            (self.floats, text.lenient_float, T.FloatType()),
            (self.dates, text.parse_date, T.DateType()),
        ):
            found.update({name: (parser, kind) for name in names})
        return found

    def silver_schema(self) -> T.StructType:
        """Schema after cleaning, derived from the raw columns and the rules above."""
        parsed = self.parsers()
        fields = [
            T.StructField(c, parsed[c][1] if c in parsed else T.StringType())
            for c in self.raw_columns
            if c not in self.dropped
        ]
        parts = [p for pair in self.pairs for p in (pair.first, pair.second)]
        return T.StructType(fields + [T.StructField(p, T.StringType()) for p in parts])


# Columns, thresholds and drops of each category.
PASSING = CleanSpec(
    name="passing",
    zero_marks=(
        "passes_attempted", "passes_completed", "completion_percentage", "passing_yards",
        "passing_yards_per_attempt", "td_passes", "ints", "sacks",
    ),
    zero_marks_after_dedup=True,
    dedup=ROW,
    ints=("passes_attempted", "passes_completed", "passing_yards", "td_passes", "ints"),
    floats=("completion_percentage", "passing_yards_per_attempt", "sacks"),
    keep=Keep((("passing_yards", ">=", 1000),)),
    dropped=(
        "position", "pass_attempts_per_game", "percentage_of_tds_per_attempts", "int_rate",
        "longest_pass", "passes_longer_than_20_yards", "passes_longer_than_40_yards",
        "sacked_yards_lost", "name",
    ),
)
RUSHING = CleanSpec(
    name="rushing",
    zero_marks=ALL,
    dedup=ROW,
    ints=("rushing_attempts", "rushing_yards", "rushing_tds", "rushing_first_downs", "fumbles"),
    floats=("yards_per_carry",),
    marker_ints=("longest_rushing_run",),
    keep=Keep((("rushing_yards", ">=", 1000),)),
    dropped=(
        "rushing_attempts_per_game", "rushing_yards_per_game", "rushing_more_than_20_yards",
        "rushing_more_than_40_yards", "name",
    ),
)
RECEIVING = CleanSpec(
    name="receiving",
    zero_marks=ALL,
    ints=("receptions", "receiving_yards", "receiving_tds", "first_down_receptions", "fumbles"),
    marker_ints=("longest_reception",),
    keep=Keep((("receiving_yards", ">=", 1000),)),
    dropped=(
        "position", "yards_per_reception", "yards_per_game", "receptions_longer_than_20_yards",
        "receptions_longer_than_40_yards", "first_down_receptions", "name",
    ),
)
DEFENSIVE = CleanSpec(
    name="defensive",
    zero_marks=ALL,
    dedup=ROW,
    ints=(
        "solo_tackles", "assisted_tackles", "passes_defended", "ints", "ints_for_tds",
        "int_yards", "safties",
    ),
    floats=("sacks", "total_tackles"),
    keep=Keep((("total_tackles", ">=", 100), ("sacks", ">", 10), ("ints", ">", 5)), any_of=True),
    year_floor=None,
    dropped=("yards_per_int", "longest_int_return", "name"),
)
KICKING = CleanSpec(
    name="kicking",
    zero_marks=ALL,
    digit_ints=(
        "kicks_blocked", "longest_fg_made", "fgs_made", "fgs_attempted",
        "fgs_made_2029_yards", "fgs_attempted_2029_yards",
        "fgs_made_3039_yards", "fgs_attempted_3039_yards",
        "fgs_made_4049_yards", "fgs_attempted_4049_yards",
        "fgs_made_50_yards", "fgs_attempted_50_yards",
        "extra_points_attempted", "extra_points_made",
    ),
    floats=(
        "fg_percentage", "fgs_percentage_2029_yards", "fgs_percentage_3039_yards",
        "fgs_percentage_4049_yards", "fgs_percentage_50_yards", "percentage_of_extra_points",
    ),
    keep=Keep((("fgs_made", ">=", 20),)),
    dropped=("position", "kicks_blocked", "extra_points_blocked", "name"),
)
_RETURN_COUNTS = (
    "kick_returns", "yards_kick_returned", "kick_returns_for_tds", "punt_returns",
    "yards_punt_returned", "punt_returns_for_tds",
)
RETURNS = CleanSpec(
    name="returns",
    zero_marks=_RETURN_COUNTS,
    dedup=ROW,
    ints=_RETURN_COUNTS,
    keep=Keep((("kick_returns_for_tds", ">=", 1), ("punt_returns_for_tds", ">=", 1))),
    dropped=("name",),
)
PLAYERS = CleanSpec(
    name="players",
    dedup=("player_id", "years_played"),
    pairs=(
        Pair("name", "last_name", "first_name", text.LENIENT_PAIR),
        Pair("birth_place", "birth_city", "birth_state", text.LENIENT_PAIR),
    ),
    required=("birthday",),
    dates=("birthday",),
    year_floor=None,
    dropped=(
        "age", "height_inches", "high_school", "number", "position", "weight_lbs",
        "years_played", "birth_place", "name",
    ),
)

FULL: dict[str, CleanSpec] = {
    s.name: s for s in (PASSING, RUSHING, RECEIVING, DEFENSIVE, KICKING, RETURNS, PLAYERS)
}
# A newer snapshot is cleaned by the same rules, but for the narrower defensive test.
INCREMENTAL: dict[str, CleanSpec] = {
    **FULL,
    "defensive": replace(DEFENSIVE, keep=Keep((("total_tackles", ">=", 100),))),
}
STAT_CATEGORIES = tuple(name for name in FULL if name != "players")


def clean_spec(category: str, mode: str = "full") -> CleanSpec:
    try:
        return {"full": FULL, "incremental": INCREMENTAL}[mode][category]
    except KeyError:
        raise ValueError(f"no cleaning rules for category {category!r}, mode {mode!r}") from None


@dataclass(frozen=True)
class RollupSpec:
    """Sums per key: result column -> silver column."""

    name: str
    sums: dict[str, str]


# Summed columns of each category.
ROLLUPS: dict[str, RollupSpec] = {
    spec.name: spec
    for spec in (
        RollupSpec("passing", {"passing_yards": "passing_yards", "passing_tds": "td_passes"}),
        RollupSpec("rushing", {"rushing_yards": "rushing_yards", "rushing_tds": "rushing_tds"}),
        RollupSpec(
            "receiving", {"receiving_yards": "receiving_yards", "receiving_tds": "receiving_tds"}
        ),
        RollupSpec(
            "defensive", {"total_tackles": "total_tackles", "sacks": "sacks", "ints": "ints"}
        ),
        RollupSpec("kicking", {"fgs_made": "fgs_made"}),
        RollupSpec(
            "returns",
            {
                "kick_return_tds": "kick_returns_for_tds",
                "punt_return_tds": "punt_returns_for_tds",
            },
        ),
    )
}
