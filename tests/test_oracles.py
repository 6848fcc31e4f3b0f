"""Registered queries against their SQL. DRAFTLAKE_ALL=1 runs all of them."""

import os

import pytest
from oracle import compare, connect

from draftlake.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
CORE = [
    "team_item_profile", "pair_synergy_all_time", "pair_counter_full_drafts", "actor_team_history", "actor_item_profile_all_time",
    "item_priors", "top_partners", "actor_cards", "rosters", "head_to_head", "draft_validation", "verify_template_lines",
    "derive_phases", "draft_context", "decisions", "candidates", "train_split", "candidate_features", "replay_random",
    "season_at", "mean_partner_rate", "decode_players", "expand_timeseries", "ref_envelope", "build_abilities", "build_seasons",
    "stored_upserts", "stored_retention", "refresh_current", "snapshot_append", "stored_players_of_contests", "fallback_views", "chosen_features",
    "recommend_requests", "value_examples", "document_files", "stream_dedup_expiry", "unusable_items", "upsert_contests", "upsert_partial", "partition_health", "quarantine_replay", "stream_dedup", "stream_outcome_windows",
]
NAMES = list(QUERIES) if os.environ.get("DRAFTLAKE_ALL") else CORE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem, rows, _, _ = compare(spark, con, SF_DIR, name)
    assert problem is None
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
