"""Schemas of the raw, silver and gold tables.

Misspelled names are part of the data model and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw tables, in table order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    name: tuple(columns.split())
    for name, columns in {
        "passing": """
            player_id name position year team games_played passes_attempted passes_completed
            completion_percentage pass_attempts_per_game passing_yards passing_yards_per_attempt
            td_passes percentage_of_tds_per_attempts ints int_rate longest_pass
            passes_longer_than_20_yards passes_longer_than_40_yards sacks sacked_yards_lost
            passer_rating""",
        "rushing": """
            player_id name postion year team games_played rushing_attempts
            rushing_attempts_per_game rushing_yards yards_per_carry rushing_yards_per_game
            rushing_tds longest_rushing_run rushing_first_downs percentage_of_rushing_first
            rushing_more_than_20_yards rushing_more_than_40_yards fumbles""",
        "receiving": """
            player_id name position year team games_played receptions receiving_yards
            yards_per_reception yards_per_game longest_reception receiving_tds
            receptions_longer_than_20_yards receptions_longer_than_40_yards
            first_down_receptions fumbles""",
        "defensive": """
            player_id name postion year team games_played total_tackles solo_tackles
            assisted_tackles sacks safties passes_defended ints ints_for_tds int_yards
            yards_per_int longest_int_return""",
        "kicking": """
            player_id name position year team games_played kicks_blocked longest_fg_made
            fgs_made fgs_attempted fg_percentage
            fgs_made_2029_yards fgs_attempted_2029_yards fgs_percentage_2029_yards
            fgs_made_3039_yards fgs_attempted_3039_yards fgs_percentage_3039_yards
            fgs_made_4049_yards fgs_attempted_4049_yards fgs_percentage_4049_yards
            fgs_made_50_yards fgs_attempted_50_yards fgs_percentage_50_yards
            extra_points_attempted extra_points_made percentage_of_extra_points
            extra_points_blocked""",
        "returns": """
            player_id name position year team games_played kick_returns yards_kick_returned
            kick_returns_for_tds punt_returns yards_punt_returned punt_returns_for_tds""",
        "players": """
            age birth_place birthday college current_status current_team experience
            height_inches high_school name number player_id position weight_lbs years_played""",
    }.items()
}


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType()}


def typed_schema(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs separated by commas; needs no session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def raw_schema(category: str) -> T.StructType:
    """All-text schema of a raw table; a newer snapshot of it has the same one."""
    return text_schema(RAW_COLUMNS[category])


# Names and types of the dimension and fact tables. The columns of the college
# dimension are its caller's, but for the key, ``school``.
TEAMS_DIM = text_schema(
    "team_name home_stadium location lat long mascot live_mascots conference division "
    "superbowl_wins year_est".split()
)
POSITIONS_DIM = typed_schema("position_key int, name string, difficulty int")
PLAYERS_DIM = typed_schema(
    "player_key int, first_name string, last_name string, city string, state string, "
    "current_status string"
)
POSITIONS = [
    (1, "quarterback", 10),
    (2, "runningback", 8),
    (3, "wide receiver", 6),
    (4, "dline/linebacker", 7),
    (5, "db", 8),
    (6, "kicker", 5),
    (7, "return specialist", 9),
]
FACT_MEASURES = (
    "passing_yards passing_tds rushing_yards rushing_tds receiving_yards receiving_tds "
    "total_tackles sacks ints fgs_made kick_return_tds punt_return_tds"
).split()


def fact_schema(measure_type: str = "int") -> T.StructType:
    measures = ", ".join(f"{m} {measure_type}" for m in FACT_MEASURES)
    return typed_schema(
        "player_key int, college_key string, team_key string, position_key int, "
        f"{measures}, years_played string, good_years int"
    )
