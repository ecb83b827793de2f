
from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import entry_data as data
import entry_oracle as oracle
from tierflow.functions import text
from tierflow.operators import (
    blanks_to_null,
    career_totals,
    distinct_rows,
    first_per_key,
    fuse_outer,
    fuse_union,
    max_per_key,
    merge_copies,
    modal_value,
    modal_value_rows,
    normalise_header,
    pair_counts,
    refine,
    replace_dashes,
    rollup,
    row_counts,
    safe_float,
    safe_int,
    trim_all,
    union_columns,
    year_span,
)
from tierflow.operators.join import hot_left_join
from tierflow.plans import (
    BatchConfig,
    backfill_max,
    backfill_null_only,
    build_fact,
    college_dim,
    college_ranking,
    college_scores,
    content_gate_report,
    gate_report,
    match_audit,
    match_summary,
    player_teams,
    players_dim,
    positions_dim,
    refresh_category,
    run_batch,
    teams_dim,
    update_fact,
    write_refined,
)
from tierflow.plans.bucketed import bucketed_fact, save_fact_tables
from tierflow.plans.ledger import LedgerConfig, read_gold, read_pair, run_ledger
from tierflow.plans.star import main_position, years_played
from tierflow.schemas import RAW_COLUMNS, fact_schema, raw_schema
from tierflow.settings import tune
from tierflow.sources import (
    commit_tables,
    delete,
    drop_table,
    external_table,
    load_commit,
    load_csv,
    publish,
    read_csv,
    read_partitions,
    read_raw,
    read_silver,
    read_table,
    read_version,
    refresh_partitions,
    rename_table,
    replace_folder,
    save_table,
    shared_folder,
    write_partitions,
    write_raw,
    write_silver,
)
from tierflow.specs import ROLLUPS, STAT_CATEGORIES, clean_spec

Query = Callable[[SparkSession, str], DataFrame]


# Tables that several queries start from. As in a real run, the cleaned tables are written to
# the shared folder before later steps read them; once per session. The runs write their raw tables too.

_stored: dict[tuple[str, ...], str] = {}


def needs_folder(spark: SparkSession) -> None:
    """A local session without a checkpoint folder gets a temporary one, as in tests."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tierflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)


def _gone(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        delete(spark, folder)


def new_folder(spark: SparkSession) -> str:
    """A shared folder that is deleted when Python ends."""
    folder = shared_folder(spark)
    atexit.register(_gone, spark, folder)
    return folder


def stored(spark: SparkSession, key: tuple[str, ...], build: Callable[[], DataFrame]) -> str:
    """Folder of the table that ``build`` gives."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _stored:
        folder = new_folder(spark)
        write_silver(build(), folder)
        _stored[key] = folder
    return _stored[key]


def raw_table(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    """The raw table, from where a query has stored it, else made anew, as most queries read it once.

    What isn't deduplicated goes through its tasks row by row, whatever their size.
    """
    folder = _stored.get((spark.sparkContext.applicationId, sf_dir, "raw", category))
    if folder is not None:
        return read_raw(spark, category, folder)
    return data.raw(spark, sf_dir, category, row_by_row=not clean_spec(category).dedup)


def import_raw(spark: SparkSession, sf_dir: str, category: str, folder: str) -> None:
    """Write a raw table to a folder, as an import does."""
    write_raw(data.raw(spark, sf_dir, category, row_by_row=True), folder)


def cleaned(spark: SparkSession, sf_dir: str, category: str, mode: str = "full") -> DataFrame:
    return refine(raw_table(spark, sf_dir, category), clean_spec(category, mode))


def silver(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    folder = stored(
        spark, (sf_dir, "silver", category), lambda: cleaned(spark, sf_dir, category)
    )
    return read_silver(spark, clean_spec(category), folder)


def all_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {c: silver(spark, sf_dir, c) for c in (*STAT_CATEGORIES, "players")}


def stat_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {c: silver(spark, sf_dir, c) for c in STAT_CATEGORIES}


def colleges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return college_dim(data.derived(spark, sf_dir, data.COLLEGES), int_columns=data.COLLEGE_INTS)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return teams_dim(data.derived(spark, sf_dir, data.TEAMS))


def fact(spark: SparkSession, sf_dir: str, rows: str) -> DataFrame:
    return build_fact(
        all_silver(spark, sf_dir),
        colleges(spark, sf_dir),
        teams(spark, sf_dir),
        rows=rows,
        measure_type="bigint",
    )


def stored_fact(spark: SparkSession, sf_dir: str, rows: str) -> DataFrame:
    folder = stored(spark, (sf_dir, "fact", rows), lambda: fact(spark, sf_dir, rows))
    schema = fact_schema("bigint")
    if rows == "counted":
        schema = schema.add("copies", "long")
    return spark.read.schema(schema).parquet(folder)


def all_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stat_silver(spark, sf_dir).values()
    return union_columns(tables, ["player_id", "team"])


# Cleaning of columns.


def clean_header(spark, sf_dir):
    customer = data.table(spark, sf_dir, "customer")
    return normalise_header(
        customer.toDF(*[f" {c.upper().replace('_', ' ')}! " for c in customer.columns])
    )


def trim_strings(spark, sf_dir):
    return trim_all(data.raw(spark, sf_dir, "rushing"))


def placeholder_all(spark, sf_dir):
    return replace_dashes(trim_all(data.raw(spark, sf_dir, "receiving")))


def placeholder_subset(spark, sf_dir):
    return replace_dashes(
        trim_all(data.raw(spark, sf_dir, "returns")), clean_spec("returns").zero_marks
    )


def placeholder_after_dedup(spark, sf_dir):
    rows = trim_all(data.raw(spark, sf_dir, "returns")).dropDuplicates()
    return replace_dashes(rows, ["kick_returns", "punt_returns_for_tds"])


def blank_strings(spark, sf_dir):
    return blanks_to_null(trim_all(data.raw(spark, sf_dir, "kicking")))


def extract_keys(spark, sf_dir):
    return data.raw(spark, sf_dir, "passing").selectExpr(
        "player_id AS source", f"{text.extract_key('player_id')} AS player_id"
    )


def split_strict(spark, sf_dir):
    last, first = text.split_pair("trim(name)")
    return (
        data.raw(spark, sf_dir, "rushing")
        .selectExpr("name", f"{last} AS last_name", f"{first} AS first_name")
        .filter("first_name IS NOT NULL")
    )


def split_lenient(spark, sf_dir):
    city, state = text.split_pair("trim(birth_place)", text.LENIENT_PAIR)
    return data.raw(spark, sf_dir, "players").selectExpr(
        "birth_place", f"{city} AS birth_city", f"{state} AS birth_state"
    )


def parse_int_commas(spark, sf_dir):
    return data.raw(spark, sf_dir, "receiving").selectExpr(
        "receiving_yards AS source", f"{text.comma_int('receiving_yards')} AS value"
    )


def parse_int_digits(spark, sf_dir):
    return data.raw(spark, sf_dir, "kicking").selectExpr(
        f"{text.digits_int('longest_fg_made')} AS longest_fg_made",
        f"{text.digits_int('extra_points_made')} AS extra_points_made",
    )


def parse_float(spark, sf_dir):
    return data.raw(spark, sf_dir, "defensive").selectExpr(
        "total_tackles AS source", f"{text.lenient_float('total_tackles')} AS value"
    )


def strip_marker(spark, sf_dir):
    return data.raw(spark, sf_dir, "rushing").selectExpr(
        "longest_rushing_run AS source", f"{text.marker_int('longest_rushing_run')} AS value"
    )


def safe_numbers(spark, sf_dir):
    rows = data.raw(spark, sf_dir, "passing").select("passing_yards", "td_passes", "sacks")
    return safe_float(safe_int(rows, ["passing_yards", "td_passes"]), ["sacks"])


def parse_dates(spark, sf_dir):
    return data.raw(spark, sf_dir, "players").selectExpr(
        "birthday AS source", f"{text.parse_date('trim(birthday)')} AS birthday"
    )


# Filters, alone.


def filter_threshold_year(spark, sf_dir):
    rows = data.raw(spark, sf_dir, "rushing").selectExpr(
        f"{text.extract_key('player_id')} AS player_id",
        f"{text.comma_int('rushing_yards')} AS rushing_yards",
        "trim(year) AS year",
    )
    return rows.filter(f"rushing_yards >= 1000 AND {text.lenient_int('year')} >= 1970")


def filtered(spark: SparkSession, sf_dir: str, category: str, keep_null: bool = False) -> DataFrame:
    """The columns a category's row test reads, parsed, of the rows that pass it."""
    spec = clean_spec(category)
    parsers = spec.parsers()
    tested = [name for name, _, _ in spec.keep.tests]
    rows = data.raw(spark, sf_dir, category).selectExpr(
        *[f"{parsers[c][0](c)} AS {c}" for c in ("player_id", *tested)]
    )
    return rows.filter(spec.keep.condition(tested, keep_null))


def filter_position(spark, sf_dir):
    return stored_fact(spark, sf_dir, "counted").filter("position_key = 2")


def filter_key_null(spark, sf_dir):
    return stored_fact(spark, sf_dir, "counted").filter("college_key IS NULL")


# Deduplication.


def _coarse_events(spark, sf_dir):
    return data.table(spark, sf_dir, "events").selectExpr(
        "concat('  ', event_type, ' ') as event_type",
        "concat('u/', cast(user_id as string)) as player_id",
        "case when user_id % 5 = 0 then ' ' else cast(year(ts) as string) end as year",
    )


def dedup_rows(spark, sf_dir):
    return blanks_to_null(trim_all(_coarse_events(spark, sf_dir))).dropDuplicates()


def dedup_keys(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return first_per_key(
        orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_totalprice", "o_orderkey"]
    )


def distinct_pairs(spark, sf_dir):
    return distinct_rows(data.table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"])


# Cleaning jobs.


def refine_keep_null(spark, sf_dir):
    return refine(
        raw_table(spark, sf_dir, "rushing"), clean_spec("rushing"), keep_null_measures=True
    )


def refine_missing_columns(spark, sf_dir):
    rows = raw_table(spark, sf_dir, "receiving").drop("fumbles", "longest_reception", "year")
    return refine(rows, clean_spec("receiving"), missing="null")


# Aggregations.


def rollup_of(category: str) -> Query:
    return lambda spark, sf_dir: rollup(silver(spark, sf_dir, category), ROLLUPS[category])


def year_spans(spark, sf_dir):
    return year_span(stat_silver(spark, sf_dir).values())


def freq_pair(spark, sf_dir):
    return pair_counts(all_teams(spark, sf_dir), "player_id", "team")


def max_college(spark, sf_dir):
    return max_per_key(silver(spark, sf_dir, "players"), "player_id", "college")


def audit_counts(spark, sf_dir):
    return row_counts(
        {f"v_{c}": rollup(t, ROLLUPS[c]) for c, t in stat_silver(spark, sf_dir).items()}
    )


def fuse_by_joins(spark, sf_dir):
    tables = stat_silver(spark, sf_dir)
    return fuse_outer({c: rollup(t, ROLLUPS[c]) for c, t in tables.items()})


def fuse_by_union(spark, sf_dir):
    return fuse_union(stat_silver(spark, sf_dir))


# Derived attributes.


def good_years(spark, sf_dir):
    return career_totals(stat_silver(spark, sf_dir)).selectExpr(
        "player_id", "good_years", f"{years_played()} AS years_played"
    )


def position_class(spark, sf_dir):
    totals = fuse_union(stat_silver(spark, sf_dir))
    return totals.selectExpr("player_id", f"{main_position()} AS position_key")


def modal_one(spark, sf_dir):
    return modal_value(all_teams(spark, sf_dir), "player_id", "team")


def modal_rows(spark, sf_dir):
    return modal_value_rows(all_teams(spark, sf_dir), "player_id", "team")


def attribute_fallback(spark, sf_dir):
    usual = modal_value(all_teams(spark, sf_dir), "player_id", "team")
    return player_teams(silver(spark, sf_dir, "players"), usual)


def fact_default(spark, sf_dir):
    return fact(spark, sf_dir, "repeated")


def fact_counted(spark, sf_dir):
    return fact(spark, sf_dir, "counted")


def fact_one_row(spark, sf_dir):
    return fact(spark, sf_dir, "single")


# Dimensions and repair.


def dim_positions(spark, sf_dir):
    """The constant table, with the number of players that have each position."""
    classes = position_class(spark, sf_dir).groupBy("position_key").agg(
        F.expr("count(*) AS players")
    )
    return (
        positions_dim(spark)
        .join(classes, "position_key", "left")
        .withColumn("players", F.coalesce("players", F.lit(0)).cast("long"))
    )


def dim_players(spark, sf_dir):
    return players_dim(silver(spark, sf_dir, "players"))


def repair_first(spark, sf_dir):
    return backfill_null_only(stored_fact(spark, sf_dir, "counted"), silver(spark, sf_dir, "players"))


def repair_recurring(spark, sf_dir):
    return backfill_max(stored_fact(spark, sf_dir, "counted"), silver(spark, sf_dir, "players"))


def repair_rows(spark, sf_dir):
    return backfill_max(stored_fact(spark, sf_dir, "repeated"), silver(spark, sf_dir, "players"))


def audit_match(spark, sf_dir):
    return match_audit(silver(spark, sf_dir, "players"), colleges(spark, sf_dir))


def audit_match_summary(spark, sf_dir):
    return match_summary(silver(spark, sf_dir, "players"), colleges(spark, sf_dir))


def ranking(spark, sf_dir):
    folder = stored(
        spark,
        (sf_dir, "college_scores"),
        lambda: college_scores(stored_fact(spark, sf_dir, "counted"), positions_dim(spark)),
    )
    return college_ranking(spark.read.parquet(folder))


# Refresh, files and whole runs.


def refresh_gate(spark, sf_dir):
    orders, lineitem = data.table(spark, sf_dir, "orders"), data.table(spark, sf_dir, "lineitem")
    return gate_report(
        {
            "larger": (orders, lineitem),
            "smaller": (lineitem, orders),
            "equal": (orders, orders),
            "missing": (orders, None),
        }
    )


def csv_load(spark, sf_dir):
    """Conversations as CSV, loaded twice into one table; texts hold line breaks."""
    folder = new_folder(spark)
    turns = data.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("Conv Id"),
        F.col("turn").cast("string").alias(" Turn #"),
        F.col("role").alias("Role!"),
        F.expr("CASE turn % 5 WHEN 4 THEN NULL WHEN 3 THEN '' ELSE text END AS TEXT"),
    )
    turns.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{folder}/in")
    name = f"turns_{uuid.uuid4().hex}"
    load_csv(spark, f"{folder}/in", name, location=f"{folder}/table")
    return load_csv(spark, f"{folder}/in", name, location=f"{folder}/table")


def raw_external_table(spark, sf_dir):
    folder = new_folder(spark)
    import_raw(spark, sf_dir, "receiving", folder)
    name = f"raw_{uuid.uuid4().hex}"
    return external_table(spark, name, raw_schema("receiving"), folder)


def silver_files(spark, sf_dir):
    folder = new_folder(spark)
    write_silver(cleaned(spark, sf_dir, "kicking"), folder)
    return read_silver(spark, clean_spec("kicking"), folder)


def fact_orc_table(spark, sf_dir):
    name = f"fact_{uuid.uuid4().hex}"
    return save_table(fact(spark, sf_dir, "single"), name, location=new_folder(spark))


def gold_append(spark, sf_dir):
    folder = new_folder(spark)
    for _ in range(2):
        publish({"players_dim": dim_players(spark, sf_dir)}, folder, "append")
    return spark.read.orc(f"{folder}/players_dim")


def gold_overwrite(spark, sf_dir):
    folder = new_folder(spark)
    for mode in ("append", "overwrite"):
        publish({"teams_dim": teams(spark, sf_dir)}, folder, mode)
    return spark.read.orc(f"{folder}/teams_dim")


def refresh_snapshot(spark, sf_dir):
    """Raw table with half of the snapshot's rows; silver must come from the snapshot."""
    folder = new_folder(spark)
    first = data.raw_selects("defensive")[0]
    write_raw(data.derived(spark, sf_dir, first), f"{folder}/raw")
    snapshot = stored(
        spark, (sf_dir, "raw", "defensive"), lambda: data.raw(spark, sf_dir, "defensive", row_by_row=True)
    )
    refresh_category(spark, "defensive", f"{folder}/raw", snapshot, f"{folder}/silver")
    return read_silver(spark, clean_spec("defensive"), f"{folder}/silver")


def self_overwrite(spark, sf_dir):
    """Repair of the stored fact, written over the folder it is read from."""
    folder = new_folder(spark)
    fact(spark, sf_dir, "single").write.parquet(folder)
    stored = spark.read.schema(fact_schema("bigint")).parquet(folder)
    players = silver(spark, sf_dir, "players")
    replace_folder(backfill_max(stored, players, unique=True), folder)
    return spark.read.schema(fact_schema("bigint")).parquet(folder)


def batch_folders(spark, fact_rows: str) -> BatchConfig:
    folder = new_folder(spark)
    return BatchConfig(
        *[f"{folder}/{layer}" for layer in ("raw", "snapshot", "silver", "gold")],
        fact_rows=fact_rows,
        measure_type="bigint",
        college_ints=data.COLLEGE_INTS,
    )


def run_batches(spark, sf_dir, config: BatchConfig, runs: tuple[bool, ...]) -> DataFrame:
    """The published fact after the runs; ``True`` is a first load."""
    for first in runs:
        run_batch(spark, config, colleges(spark, sf_dir), teams(spark, sf_dir), first)
    return spark.read.orc(config.of("gold", "fact_player_stats"))


def full_batch(spark, sf_dir):
    """First load, then a run without newer snapshots; the published fact."""
    config = batch_folders(spark, "counted")
    for category in RAW_COLUMNS:
        import_raw(spark, sf_dir, category, config.of("raw", category))
    return run_batches(spark, sf_dir, config, (True, False))


def first_load_gold(spark, sf_dir):
    """The published fact between the first load and any later run."""
    config = batch_folders(spark, "counted")
    for category in RAW_COLUMNS:
        import_raw(spark, sf_dir, category, config.of("raw", category))
    return run_batches(spark, sf_dir, config, (True,))


def batch_single_first(spark, sf_dir):
    """First load with one fact row per player, also for players of several colleges."""
    config = batch_folders(spark, "single")
    for category in RAW_COLUMNS:
        import_raw(spark, sf_dir, category, config.of("raw", category))
    return run_batches(spark, sf_dir, config, (True,))


def refreshed_batch(spark, sf_dir) -> BatchConfig:
    """A batch after a run with two grown snapshots, a smaller one and one that isn't complete.

    Passing and defensive start with the first of their two sources; receiving's snapshot
    lacks rows, rushing's has them all twice but no marker of success.
    """
    config = batch_folders(spark, "counted")
    grown = ("passing", "defensive")
    for category in RAW_COLUMNS:
        if category in grown:
            import_raw(spark, sf_dir, category, config.of("snapshot", category))
            rows = data.derived(spark, sf_dir, data.raw_selects(category)[0])
            write_raw(rows, config.of("raw", category))
        else:
            import_raw(spark, sf_dir, category, config.of("raw", category))
    fewer = read_raw(spark, "receiving", config.of("raw", "receiving")).filter("receiving_yards <> '--'")
    write_raw(fewer, config.of("snapshot", "receiving"))
    rushing = read_raw(spark, "rushing", config.of("raw", "rushing"))
    unfinished = config.of("snapshot", "rushing")
    write_raw(rushing.union(rushing), unfinished)
    delete(spark, f"{unfinished}/_SUCCESS")
    run_batches(spark, sf_dir, config, (True, False))
    return config


def full_batch_refresh(spark, sf_dir):
    config = refreshed_batch(spark, sf_dir)
    return spark.read.orc(config.of("gold", "fact_player_stats"))


def full_batch_refresh_rows(spark, sf_dir):
    """Rows of each raw and silver folder after the refresh."""
    config = refreshed_batch(spark, sf_dir)
    tables = {}
    for category in RAW_COLUMNS:
        tables[f"raw_{category}"] = read_raw(spark, category, config.of("raw", category))
        spec = clean_spec(category)
        tables[f"silver_{category}"] = read_silver(spark, spec, config.of("silver", category))
    return row_counts(tables)


def catalog_rename(spark, sf_dir):
    """A managed table, renamed with a comment, read under its new name."""
    old, new = f"old_{uuid.uuid4().hex}", f"new_{uuid.uuid4().hex}"
    save_table(dim_players(spark, sf_dir), old, location=new_folder(spark))
    comment = "one row per player's years"
    found = rename_table(spark, old, new, comment)
    assert not spark.catalog.tableExists(old)
    return found.withColumn("comment", F.lit(spark.catalog.getTable(new).description))


def catalog_drop(spark, sf_dir):
    """Two tables of a database of their own, one dropped twice: what is left."""
    name = f"tier_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark)}'")
    for category in ("kicking", "returns"):
        save_table(cleaned(spark, sf_dir, category), f"{name}.{category}")
    for _ in range(2):
        drop_table(spark, f"{name}.kicking")
    left = [t.name for t in spark.catalog.listTables(name)]
    return row_counts({t: read_table(spark, f"{name}.{t}") for t in left})


def csv_guard(spark, sf_dir):
    """Rows read from the turns as CSV, from files without any line, and from no files."""
    folder = new_folder(spark)
    turns = data.table(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as string) conv_id", "cast(turn as string) turn", "role", "text"
    )
    turns.write.options(header=True, escape='"').csv(f"{folder}/turns")
    turns.select("text").filter("false").write.text(f"{folder}/empty")
    found = []
    for source in ("turns", "empty", "missing"):
        try:
            rows = read_csv(spark, f"{folder}/{source}")
        except (ValueError, AnalysisException) as error:
            why = "no header" if isinstance(error, ValueError) else "no files"
            rows = spark.createDataFrame([], "role string")
            found.append(rows.agg(F.count("*").alias("c")).selectExpr(f"'{source}' AS source", "c", f"'{why}' AS error"))
        else:
            found.append(rows.selectExpr(f"'{source}' AS source", "count(*) AS c", "CAST(NULL AS STRING) AS error"))
    return found[0].union(found[1]).union(found[2])


# Versions, changes, and runs that can be interrupted.


def versioned_swap(spark, sf_dir):
    """Two tables before and after a commit; the plans that read the old version run after it."""
    root = new_folder(spark)
    tables = {c: silver(spark, sf_dir, c) for c in ("rushing", "receiving")}
    commit_tables(spark, root, {c: t.where("player_id % 2 = 0") for c, t in tables.items()})

    def look(when: str) -> list[DataFrame]:
        version = load_commit(spark, root)
        return [
            read_version(spark, root, c, clean_spec(c).silver_schema(), version).selectExpr(
                f"'{when}' AS version", f"'{c}' AS name", "count(*) AS c", f"sum({c}_yards) AS yards"
            )
            for c in tables
        ]

    before = look("before")
    commit_tables(spark, root, tables)
    first, *rest = [*before, *look("after")]
    for part in rest:
        first = first.union(part)
    return first


def older_silver(spark, sf_dir) -> dict[str, DataFrame]:
    """Silver tables as they may have been: players that are new now, changed since, or gone."""
    changes = {"players": ("college", "concat(college, ' old')"), **{
        c: ("year", "CAST(CAST(year AS int) - 1 AS string)") for c in STAT_CATEGORIES
    }}
    out = {}
    for category, table in all_silver(spark, sf_dir).items():
        column, value = changes[category]
        was = f"CASE WHEN player_id % 10 = 5 THEN {value} ELSE {column} END"
        gone = table.where("player_id % 10 = 7").withColumn("player_id", F.expr("player_id + 10000000"))
        kept = table.where("player_id IS NULL OR player_id % 10 <> 3")
        out[category] = kept.withColumn(column, F.expr(was)).unionByName(gone)
    return out


def fact_incremental(spark, sf_dir):
    """The fact of older silver tables and fewer colleges, brought up to date from the changes."""
    folder = new_folder(spark)
    schools = colleges(spark, sf_dir)
    fewer = schools.where("length(school) % 3 <> 0")
    old = {}
    for category, table in older_silver(spark, sf_dir).items():
        write_silver(table, f"{folder}/{category}")
        old[category] = read_silver(spark, clean_spec(category), f"{folder}/{category}")
    clubs = teams(spark, sf_dir)
    before = build_fact(old, fewer, clubs, measure_type="bigint")
    write_silver(before, f"{folder}/fact")
    before = spark.read.schema(fact_schema("bigint").add("copies", "long")).parquet(f"{folder}/fact")
    return update_fact(
        before, old, all_silver(spark, sf_dir), schools, clubs, folder, measure_type="bigint",
        dimensions={"college": (fewer.select("school"), schools.select("school"))},
    )


def refresh_gate_content(spark, sf_dir):
    """Snapshots with the same, reordered, changed, swapped, fewer and more rows, and none."""
    orders = data.table(spark, sf_dir, "orders")
    swapped = "CASE o_orderkey % 4 WHEN 1 THEN o_custkey + 1 WHEN 2 THEN o_custkey - 1 ELSE o_custkey END"
    return content_gate_report(
        {
            "equal": (orders, orders),
            "permuted": (orders, orders.select(*reversed(orders.columns)).orderBy("o_totalprice")),
            "changed": (orders, orders.withColumn("o_custkey", F.expr("o_custkey + CAST(o_orderkey = 7 AS int)"))),
            "swapped": (orders, orders.withColumn("o_custkey", F.expr(swapped))),
            "shrunk": (orders, orders.where("o_orderkey <> 7")),
            "larger": (orders.where("o_orderkey <> 7"), orders),
            "missing": (orders, None),
        }
    )


def refine_audit(spark, sf_dir):
    """What the cleaning of each raw table reads, drops and can't parse, counted by the writing job."""
    folder = new_folder(spark)
    found = [
        (category, what, n)
        for category in RAW_COLUMNS
        for what, n in write_refined(
            raw_table(spark, sf_dir, category), clean_spec(category), f"{folder}/{category}"
        ).items()
    ]
    return spark.createDataFrame(found, "category string, what string, n long")


def fact_bucketed(spark, sf_dir):
    folder, prefix = new_folder(spark), f"fact_{uuid.uuid4().hex}"
    tables = save_fact_tables(spark, all_silver(spark, sf_dir), prefix, 8, folder)
    return bucketed_fact(tables, colleges(spark, sf_dir), teams(spark, sf_dir), "bigint")


def lookup_skew(spark, sf_dir):
    """Parts of order lines of which a third name one part and some none, counted by brand."""
    hot = "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part"
    lines = data.table(spark, sf_dir, "lineitem").selectExpr(hot, "l_orderkey", "l_linenumber")
    parts = data.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    found = hot_left_join(lines, parts, "part", "p_partkey", ["l_orderkey", "l_linenumber"])
    return found.groupBy("p_brand").agg(F.expr("count(*) AS c"), F.expr("count(part) AS named"))


def silver_by_year(spark, sf_dir):
    """A silver table in folders by year, first from other rows, then brought up to date."""
    folder = new_folder(spark)
    schema = clean_spec("kicking").silver_schema()
    rows = silver(spark, sf_dir, "kicking")
    older = rows.where("year % 3 <> 0").withColumn("fgs_made", F.expr("fgs_made + CAST(year % 3 = 1 AS int)"))
    gone = rows.withColumn("year", F.expr("concat(year, 'x')"))
    write_partitions(older.unionByName(gone), folder)
    refresh_partitions(rows, folder, schema)
    return read_partitions(spark, schema, folder)


class Interrupted(Exception):
    """Stands for a driver that ends in the middle of a run."""


def run_interrupted(spark, sf_dir, config: LedgerConfig, name: str, first: bool, steps=None) -> None:
    """Run until it is over, ended at each step in turn (or at those that ``steps`` picks)."""
    met: set[str] = set()

    def watch(step: str) -> None:
        if step not in met and (steps is None or step in steps):
            met.add(step)
            raise Interrupted(step)

    while True:
        try:
            run_ledger(spark, config, colleges(spark, sf_dir), teams(spark, sf_dir), name, first, watch)
            return
        except Interrupted:
            continue


def ledger_config(spark, **options) -> LedgerConfig:
    folder = new_folder(spark)
    return LedgerConfig(
        f"{folder}/root", f"{folder}/raw", f"{folder}/snapshot", measure_type="bigint",
        college_ints=data.COLLEGE_INTS, **options,
    )


def batch_resume(spark, sf_dir):
    """The fact of a first load that was ended after each write and each commit, and begun again."""
    config = ledger_config(spark)
    for category in RAW_COLUMNS:
        import_raw(spark, sf_dir, category, config.of("raw", category))
    run_interrupted(spark, sf_dir, config, "load", True)
    return read_gold(spark, config, "fact_player_stats")


def resumed_refresh(spark, sf_dir) -> LedgerConfig:
    """Three runs: a first load, one without news, one with two grown snapshots and a fact from changes."""
    config = ledger_config(spark, incremental=True)
    grown = ("passing", "defensive")
    for category in RAW_COLUMNS:
        if category in grown:
            rows = data.derived(spark, sf_dir, data.raw_selects(category)[0])
            write_raw(rows, config.of("raw", category))
        else:
            import_raw(spark, sf_dir, category, config.of("raw", category))
    fewer = read_raw(spark, "receiving", config.of("raw", "receiving")).filter("receiving_yards <> '--'")
    write_raw(fewer, config.of("snapshot", "receiving"))
    run_interrupted(spark, sf_dir, config, "load", True, ())
    run_interrupted(spark, sf_dir, config, "monday", False, ("committed:passing", "written:gold"))
    for category in grown:
        import_raw(spark, sf_dir, category, config.of("snapshot", category))
    steps = ("written:passing", "committed:defensive", "written:gold", "committed:gold")
    run_interrupted(spark, sf_dir, config, "tuesday", False, steps)
    return config


def ledger_refresh(spark, sf_dir):
    return read_gold(spark, resumed_refresh(spark, sf_dir), "fact_player_stats")


def snapshot_pair(spark, sf_dir):
    """Rows of the raw and silver tables that a reader sees before, during and after a refresh."""
    config = ledger_config(spark, gate="content")
    for category in RAW_COLUMNS:
        if category == "defensive":
            rows = data.derived(spark, sf_dir, data.raw_selects(category)[0])
            write_raw(rows, config.of("raw", category))
        else:
            import_raw(spark, sf_dir, category, config.of("raw", category))
    run_interrupted(spark, sf_dir, config, "load", True, ())
    import_raw(spark, sf_dir, "defensive", config.of("snapshot", "defensive"))
    seen: list[DataFrame] = []

    def look(when: str) -> None:
        raw, clean = read_pair(spark, config, "defensive")
        counts = row_counts({"raw": raw, "silver": clean})
        seen.append(counts.selectExpr(f"'{when}' AS seen", "vw AS name", "c"))

    def watch(step: str) -> None:
        if step.endswith(":defensive"):
            look(step.split(":")[0])

    look("before")
    run_ledger(spark, config, colleges(spark, sf_dir), teams(spark, sf_dir), "news", watch=watch)
    found = seen[0]
    for part in seen[1:]:
        found = found.union(part)
    return found


def entry(spark: SparkSession) -> DataFrame:
    """The fact table, distinct rows with their number, at the smallest scale."""
    tune(spark)
    needs_folder(spark)
    return fact_counted(spark, "/root/testdata/sf0.001")


def tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        needs_folder(spark)
        return query(spark, sf_dir)

    return run


def library_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "clean_header": clean_header,
        "trim_strings": trim_strings,
        "placeholder_all": placeholder_all,
        "placeholder_subset": placeholder_subset,
        "placeholder_after_dedup": placeholder_after_dedup,
        "blank_strings": blank_strings,
        "extract_key": extract_keys,
        "split_pair_strict": split_strict,
        "split_pair_lenient": split_lenient,
        "parse_int_commas": parse_int_commas,
        "parse_int_digits": parse_int_digits,
        "parse_float": parse_float,
        "strip_marker": strip_marker,
        "safe_numbers": safe_numbers,
        "parse_date_validated": parse_dates,
        "filter_threshold_year": filter_threshold_year,
        "filter_and": partial(filtered, category="returns"),
        "filter_or": partial(filtered, category="defensive"),
        "filter_field_goals": partial(filtered, category="kicking"),
        "filter_receiving": partial(filtered, category="receiving"),
        "filter_keep_null": partial(filtered, category="passing", keep_null=True),
        "filter_lookup": filter_position,
        "filter_key_null": filter_key_null,
        "dedup_rows": dedup_rows,
        "dedup_keys": dedup_keys,
        "distinct_pairs": distinct_pairs,
        **{f"refine_{c}": partial(cleaned, category=c) for c in RAW_COLUMNS},
        "refine_defensive_incremental": partial(cleaned, category="defensive", mode="incremental"),
        "refine_keep_null": refine_keep_null,
        "refine_missing_columns": refine_missing_columns,
        **{f"rollup_{c}": rollup_of(c) for c in STAT_CATEGORIES},
        "year_span": year_spans,
        "freq_pair": freq_pair,
        "max_per_key": max_college,
        "union_columns": all_teams,
        "audit_counts": audit_counts,
        "fuse_outer": fuse_by_joins,
        "fuse_union": fuse_by_union,
        "good_years": good_years,
        "position_class": position_class,
        "modal_value_one": modal_one,
        "modal_value_rows": modal_rows,
        "attribute_fallback": attribute_fallback,
        "fact_default": fact_default,
        "fact_counted": fact_counted,
        "fact_one_row": fact_one_row,
        "dim_positions": dim_positions,
        "dim_teams": teams,
        "dim_college": colleges,
        "dim_players": dim_players,
        "backfill_null_only": repair_first,
        "backfill_max": repair_recurring,
        "backfill_max_rows": repair_rows,
        "match_audit": audit_match,
        "match_summary": audit_match_summary,
        "college_ranking": ranking,
        "refresh_gate": refresh_gate,
        "refresh_snapshot": refresh_snapshot,
        "self_overwrite": self_overwrite,
        "csv_load": csv_load,
        "raw_external_table": raw_external_table,
        "silver_files": silver_files,
        "fact_orc_table": fact_orc_table,
        "gold_append": gold_append,
        "gold_overwrite": gold_overwrite,
        "full_batch": full_batch,
        "first_load_gold": first_load_gold,
        "batch_single_first": batch_single_first,
        "full_batch_refresh": full_batch_refresh,
        "full_batch_refresh_rows": full_batch_refresh_rows,
        "catalog_rename": catalog_rename,
        "catalog_drop": catalog_drop,
        "csv_guard": csv_guard,
        "versioned_swap": versioned_swap,
        "batch_resume": batch_resume,
        "snapshot_pair": snapshot_pair,
        "ledger_refresh": ledger_refresh,
        "fact_incremental": fact_incremental,
        "refresh_gate_content": refresh_gate_content,
        "refine_audit": refine_audit,
        "fact_bucketed": fact_bucketed,
        "lookup_skew": lookup_skew,
        "silver_by_year": silver_by_year,
    }
    return {name: tuned(query) for name, query in found.items()}


def library_oracle() -> dict[str, str]:
    o = oracle

    def raw(category: str) -> str:
        return f"({data.raw_sql(category)}) r"

    def per_column(category: str, change) -> str:
        columns = ", ".join(f"{change(c)} AS {c}" for c in RAW_COLUMNS[category])
        return f"SELECT {columns} FROM {raw(category)}"

    def trim(c: str) -> str:
        return f"trim({c})"

    def trim_dash(c: str) -> str:
        return o.dash(trim(c))

    return_counts = clean_spec("returns").zero_marks
    six = o._silver_ctes(o.CATEGORIES)
    every_team = " UNION ALL ".join(
        f"SELECT player_id, team FROM {c}_silver" for c in o.CATEGORIES
    )
    every_year = " UNION ALL ".join(
        f"SELECT player_id, year FROM {c}_silver" for c in o.CATEGORIES
    )
    views = " UNION ALL ".join(
        f"SELECT 'v_{c}' AS vw, COUNT(*) AS c FROM ({o._view(c)}) v" for c in o.CATEGORIES
    )
    orders_days = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
    )
    coarse = (
        "SELECT event_type, 'u/' || CAST(user_id AS VARCHAR) AS player_id, "
        "CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(year(ts) AS VARCHAR) END AS year FROM events"
    )
    found = {
        "clean_header": "SELECT * FROM customer",
        "trim_strings": per_column("rushing", trim),
        "placeholder_all": per_column("receiving", trim_dash),
        "placeholder_subset": per_column(
            "returns", lambda c: trim_dash(c) if c in return_counts else trim(c)
        ),
        "placeholder_after_dedup": (
            f"SELECT * REPLACE ({o.dash('kick_returns')} AS kick_returns, "
            f"{o.dash('punt_returns_for_tds')} AS punt_returns_for_tds) "
            f"FROM (SELECT DISTINCT * FROM ({per_column('returns', trim)}) t) d"
        ),
        "blank_strings": per_column("kicking", o.trimmed),
        "extract_key": (
            f"SELECT player_id AS source, {o.key('trim(player_id)')} AS player_id "
            f"FROM {raw('passing')}"
        ),
        "split_pair_strict": (
            "SELECT * FROM (SELECT name, string_split(trim(name), ', ')[1] AS last_name, "
            f"string_split(trim(name), ', ')[2] AS first_name FROM {raw('rushing')}) t "
            "WHERE first_name IS NOT NULL"
        ),
        "split_pair_lenient": (
            "SELECT birth_place, regexp_split_to_array(trim(birth_place), ',\\s*')[1] AS birth_city, "
            "regexp_split_to_array(trim(birth_place), ',\\s*')[2] AS birth_state "
            f"FROM {raw('players')}"
        ),
        "parse_int_commas": (
            f"SELECT receiving_yards AS source, {o.no_commas('trim(receiving_yards)')} AS value "
            f"FROM {raw('receiving')}"
        ),
        "parse_int_digits": (
            f"SELECT {o.digits('longest_fg_made')} AS longest_fg_made, "
            f"{o.digits('extra_points_made')} AS extra_points_made FROM {raw('kicking')}"
        ),
        "parse_float": (
            f"SELECT total_tackles AS source, {o.real('total_tackles')} AS value "
            f"FROM {raw('defensive')}"
        ),
        "strip_marker": (
            f"SELECT longest_rushing_run AS source, {o.no_marker('longest_rushing_run')} AS value "
            f"FROM {raw('rushing')}"
        ),
        "safe_numbers": (
            f"SELECT {o.no_commas('trim(passing_yards)')} AS passing_yards, "
            f"{o.no_commas('trim(td_passes)')} AS td_passes, {o.real('sacks')} AS sacks "
            f"FROM {raw('passing')}"
        ),
        "parse_date_validated": (
            f"SELECT birthday AS source, {o.date('trim(birthday)')} AS birthday "
            f"FROM {raw('players')}"
        ),
        "filter_threshold_year": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.no_commas('trim(rushing_yards)')} AS rushing_yards, trim(year) AS year "
            f"FROM {raw('rushing')}) t WHERE rushing_yards >= 1000 AND {o._YEAR}"
        ),
        "filter_and": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.no_commas('trim(kick_returns_for_tds)')} AS kick_returns_for_tds, "
            f"{o.no_commas('trim(punt_returns_for_tds)')} AS punt_returns_for_tds "
            f"FROM {raw('returns')}) t "
            "WHERE kick_returns_for_tds >= 1 AND punt_returns_for_tds >= 1"
        ),
        "filter_or": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.real('total_tackles')} AS total_tackles, {o.real('sacks')} AS sacks, "
            f"{o.no_commas('trim(ints)')} AS ints FROM {raw('defensive')}) t "
            "WHERE total_tackles >= 100 OR sacks > 10 OR ints > 5"
        ),
        "filter_field_goals": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.digits('fgs_made')} AS fgs_made FROM {raw('kicking')}) t WHERE fgs_made >= 20"
        ),
        "filter_receiving": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.no_commas('trim(receiving_yards)')} AS receiving_yards "
            f"FROM {raw('receiving')}) t WHERE receiving_yards >= 1000"
        ),
        "filter_keep_null": (
            f"SELECT * FROM (SELECT {o.key('trim(player_id)')} AS player_id, "
            f"{o.no_commas('trim(passing_yards)')} AS passing_yards FROM {raw('passing')}) t "
            "WHERE passing_yards >= 1000 OR passing_yards IS NULL"
        ),
        "filter_lookup": o.with_fact("SELECT * FROM fact WHERE position_key = 2"),
        "filter_key_null": o.with_fact("SELECT * FROM fact WHERE college_key IS NULL"),
        "dedup_rows": f"SELECT DISTINCT * FROM ({coarse}) c",
        "dedup_keys": (
            "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, "
            "o_orderpriority ORDER BY o_orderdate, o_totalprice, o_orderkey) AS rn "
            f"FROM ({orders_days}) d) t WHERE rn = 1"
        ),
        "distinct_pairs": "SELECT DISTINCT o_custkey, o_orderpriority FROM orders",
        **{f"refine_{c}": o.refine(c) for c in RAW_COLUMNS},
        "refine_defensive_incremental": o.refine("defensive", incremental=True),
        "refine_keep_null": o.refine("rushing", keep_null="rushing_yards"),
        "refine_missing_columns": (
            "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS year, CAST(NULL AS INTEGER) AS fumbles, "
            "CAST(NULL AS INTEGER) AS longest_reception) "
            f"FROM ({o.refine('receiving', year_floor=False)}) t"
        ),
        **{f"rollup_{c}": o.rollup(c) for c in o.CATEGORIES},
        "year_span": (
            f"{six} SELECT player_id, MIN(year) AS y_min, MAX(year) AS y_max "
            f"FROM ({every_year}) u GROUP BY player_id"
        ),
        "freq_pair": (
            f"{six} SELECT player_id, team, COUNT(*) AS cnt FROM ({every_team}) u "
            "GROUP BY player_id, team"
        ),
        "max_per_key": (
            f"SELECT player_id, MAX(college) AS college FROM ({o.refine('players')}) p "
            "GROUP BY player_id"
        ),
        "union_columns": f"{six} {every_team}",
        "audit_counts": f"{six} {views}",
        "fuse_outer": o.fused(),
        "fuse_union": o.with_careers(
            "SELECT * EXCLUDE (good_years, first_year, last_year) FROM careers "
            "WHERE player_id IS NOT NULL"
        ),
        "good_years": o.with_careers(
            f"SELECT player_id, good_years, {o.YEARS} AS years_played FROM careers "
            "WHERE player_id IS NOT NULL"
        ),
        "position_class": o.with_careers(
            f"SELECT player_id, CAST({o._POSITION} AS INTEGER) AS position_key FROM careers "
            "WHERE player_id IS NOT NULL"
        ),
        "modal_value_one": o.with_careers("SELECT player_id, team, n_teams AS n_values FROM usual"),
        "modal_value_rows": o.with_careers(
            "SELECT player_id, team FROM (SELECT *, UNNEST(RANGE(n_teams)) FROM usual) u"
        ),
        "attribute_fallback": o.with_careers(
            "SELECT p.player_id, COALESCE(current_team, team) AS final_team "
            "FROM players_silver p LEFT JOIN usual u ON p.player_id = u.player_id"
        ),
        "fact_default": o.with_fact(o.repeated("fact")),
        "fact_counted": o.with_fact("SELECT * FROM fact"),
        "fact_one_row": o.with_single_fact("SELECT * FROM single"),
        "dim_positions": o.with_careers(
            "SELECT position_key, name, difficulty, COUNT(player_id) AS players "
            f"FROM {o.POSITIONS} LEFT JOIN (SELECT player_id, {o._POSITION} AS position FROM careers "
            "WHERE player_id IS NOT NULL) c ON position_key = position GROUP BY ALL"
        ),
        "dim_teams": data.derived_sql(data.TEAMS),
        "dim_college": o.college_dim(),
        "dim_players": (
            "SELECT player_id AS player_key, first_name, last_name, birth_city AS city, "
            f"birth_state AS state, current_status FROM ({o.refine('players')}) p"
        ),
        "backfill_null_only": o.with_first_backfill("SELECT * FROM repaired"),
        "backfill_max": o.with_backfill("SELECT * FROM repaired"),
        "backfill_max_rows": o.with_backfill(o.repeated("repaired")),
        "match_audit": (
            f"SELECT player_id, college, school FROM ({o.refine('players')}) p "
            f"LEFT JOIN ({o.college_dim()}) d ON college = school "
            "ORDER BY player_id NULLS FIRST, college NULLS FIRST, school NULLS FIRST LIMIT 10"
        ),
        "match_summary": (
            f"SELECT school IS NOT NULL AS matched, COUNT(*) AS c FROM ({o.refine('players')}) p "
            f"LEFT JOIN ({o.college_dim()}) d ON college = school GROUP BY ALL"
        ),
        "college_ranking": o.with_fact(
            "SELECT *, dense_rank() OVER (ORDER BY weighted_years DESC) AS college_rank FROM "
            "(SELECT college_key, COUNT(*) AS players, CAST(SUM(good_years) AS BIGINT) AS good_years, "
            "CAST(SUM(good_years * difficulty) AS BIGINT) AS weighted_years FROM "
            "(SELECT DISTINCT college_key, player_key, position_key, good_years FROM fact "
            f"WHERE college_key IS NOT NULL) f JOIN {o.POSITIONS} USING (position_key) "
            "GROUP BY college_key) g"
        ),
        "refresh_gate": (
            "WITH n AS (SELECT (SELECT COUNT(*) FROM orders) AS o, "
            "(SELECT COUNT(*) FROM lineitem) AS l), p AS ("
            "SELECT 'larger' AS name, o AS raw_rows, l AS snapshot_rows FROM n UNION ALL "
            "SELECT 'smaller', l, o FROM n UNION ALL SELECT 'equal', o, o FROM n UNION ALL "
            "SELECT 'missing', o, 0 FROM n) SELECT *, snapshot_rows > raw_rows AS refresh FROM p"
        ),
        "refresh_snapshot": o.refine("defensive", incremental=True),
        "csv_load": " UNION ALL ".join(
            [
                "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn_, role, "
                "CASE turn % 5 WHEN 4 THEN NULL WHEN 3 THEN '' ELSE text END AS text FROM conversations"
            ]
            * 2
        ),
        "raw_external_table": data.raw_sql("receiving"),
        "silver_files": o.refine("kicking"),
        "fact_orc_table": o.with_single_fact("SELECT * FROM single"),
        "gold_overwrite": data.derived_sql(data.TEAMS),
        "full_batch": o.with_backfill("SELECT * FROM repaired"),
        "self_overwrite": o.with_single_backfill(),
    }
    found["first_load_gold"] = found["backfill_null_only"]
    found["batch_single_first"] = o.with_single_backfill(first=True)
    found["full_batch_refresh"] = o.with_backfill("SELECT * FROM repaired", ["defensive"])
    found["full_batch_refresh_rows"] = " UNION ALL ".join(
        f"SELECT '{layer}_{c}' AS vw, COUNT(*) AS c FROM ({rows}) t"
        for c in RAW_COLUMNS
        for layer, rows in (("raw", data.raw_sql(c)), ("silver", o.refine(c, c == "defensive")))
    )
    found["catalog_rename"] = (
        f"SELECT *, 'one row per player''s years' AS comment FROM ({found['dim_players']}) p"
    )
    found["catalog_drop"] = f"SELECT 'returns' AS vw, COUNT(*) AS c FROM ({o.refine('returns')}) t"
    found["csv_guard"] = (
        "SELECT 'turns' AS source, COUNT(*) AS c, NULL::VARCHAR AS error FROM conversations "
        "UNION ALL VALUES ('empty', 0, 'no header'), ('missing', 0, 'no files')"
    )
    found["versioned_swap"] = " UNION ALL ".join(
        f"SELECT '{when}' AS version, '{c}' AS name, COUNT(*) AS c, CAST(SUM({c}_yards) AS BIGINT) AS yards "
        f"FROM ({o.refine(c)}) t WHERE {test}"
        for when, test in (("before", "player_id % 2 = 0"), ("after", "TRUE"))
        for c in ("rushing", "receiving")
    )
    found["batch_resume"] = found["first_load_gold"]
    found["ledger_refresh"] = found["full_batch_refresh"]
    found["fact_incremental"] = found["fact_bucketed"] = found["fact_counted"]
    found["silver_by_year"] = o.refine("kicking")
    first_source = data.derived_sql(data.raw_selects("defensive")[0])
    old_pair = [
        f"SELECT COUNT(*) FROM ({first_source}) r",
        f"SELECT COUNT(*) FROM ({o.refine('defensive').replace(data.raw_sql('defensive'), first_source)}) s",
    ]
    new_pair = [
        f"SELECT COUNT(*) FROM ({data.raw_sql('defensive')}) r",
        f"SELECT COUNT(*) FROM ({o.refine('defensive', incremental=True)}) s",
    ]
    found["snapshot_pair"] = " UNION ALL ".join(
        f"SELECT '{when}' AS seen, '{name}' AS name, ({count}) AS c"
        for when, pair in (("before", old_pair), ("written", old_pair), ("committed", new_pair))
        for name, count in zip(("raw", "silver"), pair)
    )
    found["refresh_gate_content"] = o.content_gate()
    found["refine_audit"] = o.audit()
    found["lookup_skew"] = (
        "SELECT p_brand, COUNT(*) AS c, COUNT(part) AS named FROM (SELECT CASE WHEN l_orderkey % 7 = 0 "
        "THEN NULL WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part FROM lineitem) l "
        "LEFT JOIN part ON l.part = p_partkey GROUP BY p_brand"
    )
    found["gold_append"] = f"{found['dim_players']} UNION ALL {found['dim_players']}"
    return found


def _corpus():
    """Queries of the corpus operators, or None where that subpackage is not there."""
    try:
        from tierflow.llm import queries as corpus
    except ModuleNotFoundError as error:
        if error.name not in ("tierflow.llm", "corpus_pipeline"):
            raise
        return None
    return corpus


def queries() -> dict[str, Query]:
    corpus = _corpus()
    return {**library_queries(), **(corpus.QUERIES if corpus else {})}


def oracle_sql() -> dict[str, str]:
    corpus = _corpus()
    return {**library_oracle(), **(corpus.ORACLE if corpus else {})}
