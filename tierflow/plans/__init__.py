"""Star schema, refresh and whole runs."""

from tierflow.plans.audit import (
    describe,
    match_audit,
    match_summary,
    preview,
    view_counts,
    write_refined,
)
from tierflow.plans.batch import BatchConfig, first_load, gold_tables, refresh_all, run_batch
from tierflow.plans.bucketed import bucketed_fact, save_bucketed, save_fact_tables
from tierflow.plans.incremental import touched_players, update_fact
from tierflow.plans.ledger import LedgerConfig, read_gold, read_pair, run_ledger
from tierflow.plans.refresh import (
    content_gate_report,
    gate_report,
    refresh_category,
    should_refresh,
)
from tierflow.plans.star import (
    backfill_max,
    backfill_null_only,
    build_fact,
    college_dim,
    college_ranking,
    college_scores,
    player_teams,
    players_dim,
    positions_dim,
    teams_dim,
)

__all__ = [
    "BatchConfig",
    "LedgerConfig",
    "backfill_max",
    "backfill_null_only",
    "bucketed_fact",
    "build_fact",
    "college_dim",
    "college_ranking",
    "college_scores",
    "content_gate_report",
    "describe",
    "first_load",
    "gate_report",
    "gold_tables",
    "match_audit",
    "match_summary",
    "player_teams",
    "players_dim",
    "positions_dim",
    "preview",
    "read_gold",
    "read_pair",
    "refresh_all",
    "refresh_category",
    "run_batch",
    "run_ledger",
    "save_bucketed",
    "save_fact_tables",
    "should_refresh",
    "teams_dim",
    "touched_players",
    "update_fact",
    "view_counts",
    "write_refined",
]
