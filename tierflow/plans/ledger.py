"""Whole runs that can be interrupted anywhere and repeated: atomic tables and a ledger of stages.

Raw, silver and gold tables live under one root (``tierflow.sources.versions``). Each stage writes its
tables and publishes them in one commit, whose notes are the ledger: the run, its finished stages
with the version of their input, and the fingerprint of each raw table. A run that is started again under
its name skips the finished stages, so an append happens once; a category's silver and raw tables
change in one commit, so no reader sees one without the other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.changes import Fingerprint, fingerprint
from tierflow.operators.derive import repeat_rows
from tierflow.operators.refine import refine
from tierflow.plans.batch import RUN_ORDER
from tierflow.plans.incremental import update_fact
from tierflow.plans.star import (
    backfill_max,
    backfill_null_only,
    build_fact,
    college_dim,
    players_dim,
    positions_dim,
    teams_dim,
)
from tierflow.schemas import fact_schema
from tierflow.settings import tune
from tierflow.sources.paths import exists, hadoop_path, scratch, settled
from tierflow.sources.tables import RAW_OPTIONS, read_raw
from tierflow.sources.versions import (
    Commit,
    commit,
    load_commit,
    read_version,
    write_data,
)
from tierflow.specs import clean_spec

FACT = "gold_fact_player_stats"
#: Called with the name of each step when it is over.
Watch = Callable[[str], None]


@dataclass(frozen=True)
class LedgerConfig:
    """Where a run's tables are, and how it decides and builds.

    ``raw`` and ``snapshot`` are folders that imports have written, with a subfolder per category;
    ``root`` holds everything the run writes. ``gate`` is ``"rows"`` (only a snapshot with more rows is
    new) or ``"content"`` (any with other rows is). ``incremental`` lets a recurring run update the
    fact from the changes where the one before was built alike.
    """

    root: str
    raw: str
    snapshot: str
    fact_rows: str = "counted"
    measure_type: str = "int"
    college_ints: tuple[str, ...] = ()
    gate: str = "rows"
    incremental: bool = False

    def __post_init__(self):
        if self.gate not in ("rows", "content"):
            raise ValueError(f"gate={self.gate!r}")
        if self.fact_rows not in ("counted", "repeated", "single"):
            raise ValueError(f"fact_rows={self.fact_rows!r}")

    def of(self, layer: str, category: str) -> str:
        return f"{getattr(self, layer).rstrip('/')}/{category}"


def _finished(spark: SparkSession, folder: str) -> str | None:
    """When the import into a folder ended, or None if it hasn't."""
    marker = f"{folder}/_SUCCESS"
    if not exists(spark, marker):
        return None
    path, fs = hadoop_path(spark, marker)
    return str(fs.getFileStatus(path).getModificationTime())


def _is_new(config: LedgerConfig, before: Fingerprint, after: Fingerprint) -> bool:
    return after != before if config.gate == "content" else after.rows > before.rows


class Run:
    """A run under a name; ``done`` has the finished stages, each with its notes."""

    def __init__(self, spark: SparkSession, config: LedgerConfig, name: str, watch: Watch | None):
        self.spark, self.config, self.name = spark, config, name
        self.watch = watch or (lambda step: None)
        self.base = load_commit(spark, config.root)

    @property
    def done(self) -> Mapping[str, dict]:
        notes = self.base.notes
        return notes.get("done", {}) if notes.get("run") == self.name else {}

    def finish(self, stage: str, about: dict, tables: Mapping[str, str], append=(), **notes) -> None:
        """Publish a stage's folders with its entry in the ledger, in one commit."""
        self.watch(f"written:{stage}")
        kept = {k: v for k, v in self.base.notes.items() if k not in ("run", "done")}
        entry = {"run": self.name, "done": {**self.done, stage: about}}
        self.base = commit(
            self.spark, self.config.root, self.base, tables, {**kept, **notes, **entry}, append
        )
        self.watch(f"committed:{stage}")

    def marks(self) -> dict[str, dict]:
        return dict(self.base.notes.get("marks", {}))

    def silver(self, version: Commit | None = None) -> dict[str, DataFrame]:
        return {
            c: read_version(
                self.spark, self.config.root, f"silver_{c}", clean_spec(c).silver_schema(), version or self.base
            )
            for c in RUN_ORDER
        }

    # Stages.

    def load(self, category: str) -> None:
        """A category's first silver table, and its raw table, from the raw import."""
        folder = self.config.of("raw", category)
        self._publish(category, read_raw(self.spark, category, folder), "full", _finished(self.spark, folder))

    def refresh(self, category: str) -> None:
        """A category's tables from its snapshot alone, if that is new."""
        folder = self.config.of("snapshot", category)
        stamp = _finished(self.spark, folder)
        about = {"input": stamp, "changed": False}
        if stamp is None:  # missing, or still being written
            return self.finish(category, about, {})
        snapshot = read_raw(self.spark, category, folder)
        mark = fingerprint(snapshot)
        if not _is_new(self.config, Fingerprint(**self.marks()[category]), mark):
            return self.finish(category, about, {})
        self._publish(category, snapshot, "incremental", stamp, mark)

    def _publish(
        self, category: str, raw: DataFrame, mode: str, stamp: str | None, mark: Fingerprint | None = None
    ) -> None:
        root = self.config.root
        tables = {
            f"silver_{category}": write_data(root, "silver_" + category, refine(raw, clean_spec(category, mode))),
            f"raw_{category}": write_data(root, "raw_" + category, raw, **RAW_OPTIONS),
        }
        mark = mark or fingerprint(raw)
        self.finish(
            category, {"input": stamp, "changed": True}, tables,
            marks={**self.marks(), category: mark.to_dict()},
        )

    def gold(self, colleges: DataFrame, teams: DataFrame, first: bool) -> None:
        """The five gold tables from the silver tables of one version; the first load appends."""
        config, spark = self.config, self.spark
        dims = {
            "gold_positions_dim": positions_dim(spark),
            "gold_college_dim": college_dim(colleges, int_columns=config.college_ints),
            "gold_teams_dim": teams_dim(teams),
            "gold_players_dim": players_dim(self.silver()["players"]),
        }
        marks = {
            "college": fingerprint(colleges.select("school")).to_dict(),
            "team": fingerprint(teams.select("team_name")).to_dict(),
        }
        built = {
            "first": first, "rows": config.fact_rows, "type": config.measure_type, "keys": marks,
            "version": self.base.version,
        }
        with scratch(spark) as folder:
            dims[FACT] = self._fact(colleges, teams, first, built, folder)
            tables = {name: write_data(config.root, name, df, "orc") for name, df in dims.items()}
        silver = {f"silver_{c}": self.base.tables[f"silver_{c}"] for c in RUN_ORDER}
        self.finish(
            "gold", {"input": self.base.version}, tables,
            append=tables if first else (), built={**built, "silver": silver},
        )

    def _fact(self, colleges, teams, first: bool, built: dict, folder: str) -> DataFrame:
        config = self.config
        silver = self.silver()
        single = config.fact_rows == "single"
        rows = "single" if single else "counted"
        last = self.base.notes.get("built")
        alike = last and all(last[k] == built[k] for k in ("first", "rows", "type", "keys"))
        if config.incremental and alike and not first and config.fact_rows != "repeated":
            schema = fact_schema(config.measure_type)
            schema = schema if single else schema.add("copies", "long")
            old = self.silver(Commit(last["version"], last["silver"]))
            return update_fact(
                read_version(self.spark, config.root, FACT, schema, self.base, "orc"), old, silver,
                colleges, teams, folder, rows, config.measure_type,
                repair=lambda fact, players: backfill_max(fact, players, unique=single),
            )
        fact = build_fact(silver, colleges, teams, rows, config.measure_type)
        if single:
            fact = (backfill_null_only if first else backfill_max)(fact, silver["players"], unique=True)
        elif first:
            fact = backfill_null_only(settled(fact, f"{folder}/fact"), silver["players"])
        else:
            fact = backfill_max(fact, silver["players"])
        return repeat_rows(fact, "copies") if config.fact_rows == "repeated" else fact


def run_ledger(
    spark: SparkSession,
    config: LedgerConfig,
    colleges: DataFrame,
    teams: DataFrame,
    name: str,
    first: bool = False,
    watch: Watch | None = None,
) -> Commit:
    """Run, or go on with, the run called ``name``; what the tables are then.

    A first load cleans the raw imports and appends to gold; later runs look at the snapshots and
    replace gold. Stages that the ledger has as finished under this name are skipped, with what they
    read then: a snapshot that comes after its stage is for the next run. A finished run that is
    started again does nothing.
    """
    tune(spark)
    run = Run(spark, config, name, watch)
    for category in RUN_ORDER:
        if category not in run.done:
            (run.load if first else run.refresh)(category)
    if "gold" not in run.done:
        run.gold(colleges, teams, first)
    return run.base


def read_gold(
    spark: SparkSession, config: LedgerConfig, name: str, version: Commit | None = None
) -> DataFrame:
    """A gold table as the latest commit, or a given one, has it."""
    return read_version(spark, config.root, f"gold_{name}", version=version, fmt="orc")


def read_pair(
    spark: SparkSession, config: LedgerConfig, category: str, version: Commit | None = None
) -> tuple[DataFrame, DataFrame]:
    """A category's raw and silver tables of one commit."""
    version = version or load_commit(spark, config.root)
    spec = clean_spec(category)
    raw = read_version(spark, config.root, f"raw_{category}", version=version)
    silver = read_version(spark, config.root, f"silver_{category}", spec.silver_schema(), version)
    return raw, silver
