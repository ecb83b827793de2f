"""Versioned tables and ledger runs, ended at every step."""

import json
import os

import pytest

from conftest import bag
from test_refresh import rushing
from tierflow.plans import LedgerConfig, read_gold, read_pair, run_ledger
from tierflow.plans import ledger
from tierflow.schemas import RAW_COLUMNS, TEAMS_DIM, raw_schema
from tierflow.sources import (
    Commit,
    CommitConflict,
    commit,
    commit_tables,
    load_commit,
    read_version,
    vacuum,
    committed_versions,
    write_data,
)
from tierflow.sources import versions as module


def numbers(spark, low, high):
    return spark.range(low, high).toDF("n")


def found(spark, root, name="t", version=None):
    return sorted(r.n for r in read_version(spark, root, name, version=version).collect())


def test_commits_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "root")
    assert load_commit(spark, root) == Commit() and committed_versions(spark, root) == []
    commit_tables(spark, root, {"t": numbers(spark, 0, 3), "u": numbers(spark, 0, 1)}, {"by": "a"})
    second = commit_tables(spark, root, {"t": numbers(spark, 5, 6)})
    assert committed_versions(spark, root) == [1, 2] and load_commit(spark, root) == second
    assert second.notes == {"by": "a"}
    assert found(spark, root) == [5] and found(spark, root, version=1) == [0, 1, 2]
    assert found(spark, root, "u") == [0]
    with pytest.raises(KeyError, match="not in version 2"):
        read_version(spark, root, "v")


def test_a_table_can_be_written_over_what_it_reads(spark, tmp_path):
    root = str(tmp_path / "root")
    commit_tables(spark, root, {"t": numbers(spark, 0, 4)})
    old = read_version(spark, root, "t")
    commit_tables(spark, root, {"t": old.selectExpr("n + 10 AS n")})
    assert sorted(r.n for r in old.collect()) == [0, 1, 2, 3]
    assert found(spark, root) == [10, 11, 12, 13]


def test_appends_keep_what_is_there(spark, tmp_path):
    root = str(tmp_path / "root")
    commit_tables(spark, root, {"t": numbers(spark, 0, 2)}, append=["t"])
    commit_tables(spark, root, {"t": numbers(spark, 2, 3), "u": numbers(spark, 0, 1)}, append=["t"])
    assert found(spark, root) == [0, 1, 2] and found(spark, root, version=1) == [0, 1]


class Killed(Exception):
    pass


def die(*_):
    raise Killed


@pytest.mark.parametrize("step", ["rows", "second table", "record", "rename"])
def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "root")
    commit_tables(spark, root, {"t": numbers(spark, 0, 2), "u": numbers(spark, 0, 2)})
    with monkeypatch.context() as patch:
        if step == "rows":  # the job fails halfway
            bad = numbers(spark, 0, 50).selectExpr("IF(n = 40, CAST(raise_error('x') AS bigint), n) AS n")
        else:
            bad = numbers(spark, 7, 9)
        if step == "second table":
            write, calls = module.write_data, []
            patch.setattr(module, "write_data", lambda *a: die() if calls else calls.append(1) or write(*a))
        if step == "record":
            patch.setattr(module, "hadoop_path", die)
        if step == "rename":
            patch.setattr(module, "_take_number", die)
        with pytest.raises(Exception):
            commit_tables(spark, root, {"t": bad, "u": numbers(spark, 7, 9)})
    assert found(spark, root) == [0, 1] and found(spark, root, "u") == [0, 1]
    assert committed_versions(spark, root) == [1]
    commit_tables(spark, root, {"t": numbers(spark, 3, 4)})
    assert found(spark, root) == [3] and found(spark, root, "u") == [0, 1]


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    root = str(tmp_path / "root")
    base = commit_tables(spark, root, {"t": numbers(spark, 0, 1)})
    mine, theirs = (write_data(root, "t", numbers(spark, n, n + 1)) for n in (5, 6))
    commit(spark, root, base, {"t": theirs})
    with pytest.raises(CommitConflict):
        commit(spark, root, base, {"t": mine})
    assert found(spark, root) == [6]
    assert not [f for f in os.listdir(f"{root}/_commits") if f.startswith("_")]


def test_vacuum_deletes_what_no_kept_version_names(spark, tmp_path):
    root = str(tmp_path / "root")
    for n in range(4):
        commit_tables(spark, root, {"t": numbers(spark, n, n + 1)})
    left_behind = write_data(root, "t", numbers(spark, 9, 10))
    gone = vacuum(spark, root, keep=2)
    assert len(gone) == 3 and left_behind in gone
    assert committed_versions(spark, root) == [3, 4]
    assert found(spark, root) == [3] and found(spark, root, version=3) == [2]
    assert vacuum(spark, root) == []
    with pytest.raises(ValueError):
        vacuum(spark, root, keep=0)


def test_records_are_plain_text(spark, tmp_path):
    root = str(tmp_path / "root")
    commit_tables(spark, root, {"t": numbers(spark, 0, 1)}, {"who": "Ünï"})
    with open(f"{root}/_commits/000000000001.json", encoding="utf-8") as file:
        content = json.load(file)
    assert content["version"] == 1 and content["notes"] == {"who": "Ünï"}
    assert load_commit(spark, root).notes == {"who": "Ünï"}


# Runs.


def imports(spark, config, layer="raw", yards=(1000, 1200)):
    """All categories, empty but for rushing and its players."""
    for category in RAW_COLUMNS:
        rows = spark.createDataFrame([], raw_schema(category))
        if category == "rushing":
            rows = rushing(spark, yards)
        if category == "players":
            names = RAW_COLUMNS[category]
            people = [
                {"player_id": f"p/{i}", "name": "A, B", "birthday": "1/2/1980", "college": "C1"}
                for i in range(4)
            ]
            rows = spark.createDataFrame([tuple(p.get(c) for c in names) for p in people], raw_schema(category))
        rows.write.mode("overwrite").parquet(config.of(layer, category))


def dimensions(spark):
    colleges = spark.createDataFrame([("C1", "S")], "school string, state string")
    clubs = spark.createDataFrame([tuple("T1" for _ in TEAMS_DIM)], TEAMS_DIM)
    return colleges, clubs


@pytest.fixture
def config(tmp_path):
    return LedgerConfig(*[str(tmp_path / f) for f in ("root", "raw", "snapshot")])


def run(spark, config, name, first=False, watch=None):
    return run_ledger(spark, config, *dimensions(spark), name, first, watch)


def yards(spark, config):
    fact = read_gold(spark, config, "fact_player_stats")
    return sorted((r.player_key, r.rushing_yards, r.copies) for r in fact.collect())


def test_a_finished_run_does_nothing_again(spark, config):
    imports(spark, config)
    done = run(spark, config, "load", first=True)
    steps = []
    assert run(spark, config, "load", first=True, watch=steps.append) == done and steps == []
    assert yards(spark, config) == [(0, 1000, 1), (1, 1200, 1)]
    # under another name it's another load, which appends as asked for
    run(spark, config, "load again", first=True)
    assert yards(spark, config) == [(0, 1000, 1)] * 2 + [(1, 1200, 1)] * 2


def test_stages_after_an_interruption(spark, config):
    imports(spark, config)

    def stop(step):
        if step == "written:rushing":
            raise Killed

    with pytest.raises(Killed):
        run(spark, config, "load", True, stop)
    done = load_commit(spark, config.root).notes["done"]
    assert list(done) == ["players", "defensive", "kicking"]
    steps = []
    run(spark, config, "load", True, steps.append)
    assert steps[0] == "written:rushing" and not any("kicking" in s for s in steps)
    named = [f.split("/")[-1] for f in load_commit(spark, config.root).tables["silver_rushing"]]
    assert len(named) == 1 and len(os.listdir(f"{config.root}/data/silver_rushing")) == 2
    vacuum(spark, config.root, keep=1)
    assert os.listdir(f"{config.root}/data/silver_rushing") == named
    assert yards(spark, config) == [(0, 1000, 1), (1, 1200, 1)]


def test_the_input_of_a_finished_stage_is_that_of_its_time(spark, config):
    imports(spark, config)
    run(spark, config, "load", first=True)
    rushing(spark, [2000, 3000, 4000]).write.parquet(config.of("snapshot", "rushing"))

    def grow(step):
        if step == "committed:rushing":
            rushing(spark, [9000] * 4).write.mode("overwrite").parquet(config.of("snapshot", "rushing"))
            raise Killed

    with pytest.raises(Killed):
        run(spark, config, "monday", watch=grow)
    run(spark, config, "monday")
    assert [y for _, y, _ in yards(spark, config)] == [2000, 3000, 4000]
    stamp = load_commit(spark, config.root).notes["done"]["rushing"]
    assert stamp["changed"] and stamp["input"]
    run(spark, config, "tuesday")
    assert [y for _, y, _ in yards(spark, config)] == [9000] * 4


@pytest.mark.parametrize("gate, changed", [("rows", False), ("content", True)])
def test_gates(spark, tmp_path, gate, changed):
    config = LedgerConfig(*[str(tmp_path / f) for f in ("root", "raw", "snapshot")], gate=gate)
    imports(spark, config)
    run(spark, config, "load", first=True)
    rushing(spark, [1000, 5000]).write.parquet(config.of("snapshot", "rushing"))
    run(spark, config, "next")
    assert load_commit(spark, config.root).notes["done"]["rushing"]["changed"] is changed
    assert [y for _, y, _ in yards(spark, config)] == [1000, 5000 if changed else 1200]
    # the same rows in another order are nothing new
    rushing(spark, [1000, 5000]).orderBy("rushing_yards").write.mode("overwrite").parquet(
        config.of("snapshot", "rushing")
    )
    run(spark, config, "last")
    assert load_commit(spark, config.root).notes["done"]["rushing"]["changed"] is False


def test_a_reader_never_sees_a_mixed_pair(spark, config):
    imports(spark, config)
    run(spark, config, "load", first=True)
    rushing(spark, [2000, 3000, 4000]).write.parquet(config.of("snapshot", "rushing"))
    seen = []

    def look(step):
        raw, silver = read_pair(spark, config, "rushing")
        seen.append((step, raw.count(), silver.count()))

    run(spark, config, "next", watch=look)
    assert {(r, s) for _, r, s in seen} == {(2, 2), (3, 3)}
    assert dict((step, r) for step, r, _ in seen)["written:rushing"] == 2
    assert dict((step, r) for step, r, _ in seen)["committed:rushing"] == 3


def test_unfinished_and_missing_snapshots_are_left(spark, config):
    imports(spark, config)
    run(spark, config, "load", first=True)
    rushing(spark, [1] * 9).write.parquet(config.of("snapshot", "rushing"))
    os.remove(f"{config.of('snapshot', 'rushing')}/_SUCCESS")
    run(spark, config, "next")
    assert not any(s["changed"] for k, s in load_commit(spark, config.root).notes["done"].items() if k != "gold")


def test_a_fact_from_changes_is_the_whole_one(spark, tmp_path, monkeypatch):
    config = LedgerConfig(*[str(tmp_path / f) for f in ("root", "raw", "snapshot")], incremental=True)
    imports(spark, config)
    run(spark, config, "load", first=True)
    used = []
    update = ledger.update_fact
    monkeypatch.setattr(ledger, "update_fact", lambda *a, **b: used.append(1) or update(*a, **b))
    run(spark, config, "one")  # the first load is repaired by another rule
    assert not used
    rushing(spark, [1500, 1200, 1100]).write.parquet(config.of("snapshot", "rushing"))
    run(spark, config, "two")
    assert used
    assert yards(spark, config) == [(0, 1500, 1), (1, 1200, 1), (2, 1100, 1)]
    whole = LedgerConfig(config.root, config.raw, config.snapshot)
    before = bag(read_gold(spark, config, "fact_player_stats"))
    run(spark, whole, "three")
    assert bag(read_gold(spark, config, "fact_player_stats")) == before and len(used) == 1


def test_options_are_checked(tmp_path):
    with pytest.raises(ValueError, match="gate"):
        LedgerConfig("a", "b", "c", gate="x")
    with pytest.raises(ValueError, match="fact_rows"):
        LedgerConfig("a", "b", "c", fact_rows="x")


def test_raw_tables_have_no_ranges_of_their_text(spark, config):
    import glob

    import pyarrow.parquet as pq

    imports(spark, config)
    done = run(spark, config, "load", first=True)
    (folder,) = done.tables["raw_rushing"]
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{config.root}/{folder}/*.parquet")]
    columns = [m.row_group(0).column(0) for m in files if m.num_rows]
    assert columns and all(c.compression == "ZSTD" for c in columns)
    assert not any(c.statistics and c.statistics.has_min_max for c in columns)
