"""Rows of contests meet their contests by a merge: unfolded steps look small to the size check and must not be broadcast."""

import pytest

from draftlake.operators import decode, drafts, profiles
from draftlake.plans import decisions as dec
from draftlake.plans import evaluation as ev
from draftlake.sources import star
from draftlake.sources.documents import parse_documents
from draftlake.sources.tables import merge_contests
from draftlake.operators.profiles import DraftTables

QUERIES = {
    "decisions": lambda t: dec.decisions(t.steps, t.contests),
    "item_counts": lambda t: profiles.item_counts(t, t.items.select("item_id")),
    "team_items": lambda t: profiles.team_item_profile(t, None),
    "replayed": lambda t: ev.replay_candidates(t.steps, ev.replay_contests(t.contests), t.items),
    "template": lambda t: drafts.slot_template(t.steps, drafts.newest_season_sample(t.contests)),
    "players": lambda t: t.players,
}


@pytest.fixture(scope="module")
def seq(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("star"))
    spark.sql("""SELECT id AS o_orderkey, id % 7 AS o_custkey, element_at(array('F', 'O', 'P'), CAST(id % 3 AS INT) + 1) AS o_orderstatus,
        DATE'1998-01-01' AS o_orderdate, element_at(array('1-URGENT', '2-HIGH', '5-LOW'), CAST(id % 3 AS INT) + 1) AS o_orderpriority
        FROM range(1, 200)""").write.parquet(f"{d}/orders.parquet")
    spark.sql("SELECT id AS p_partkey, concat('n', id) AS p_name, 'Carry' AS p_type FROM range(130)").write.parquet(f"{d}/part.parquet")
    c = star.contests(spark, d)
    return DraftTables(c, star.sequence_steps(spark, d), star.with_contest(star.sequence_players(spark, d), c), star.sequence_items(spark, d))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_contest_side_is_broadcast(seq, name):
    physical = QUERIES[name](seq)._jdf.queryExecution().executedPlan().toString()
    assert "[contest_id" in physical
    assert not [line for line in physical.splitlines() if "Broadcast" in line and "Join" in line and "contest_id" in line]


def test_rows_of_a_sample_are_not_sorted(spark, seq):
    """Steps that are only asked whether their contest is in a sample are hashed to its ids, not sorted; odd ids are no match."""
    sample = drafts.newest_season_sample(seq.contests)
    physical = drafts.slot_template(seq.steps, sample)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in physical and "SortMergeJoin" not in physical
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 0)], "contest_id long, slot int")
    ids = spark.createDataFrame([(1,), (1,), (None,), (3,)], "contest_id long")
    assert sorted(map(tuple, merge_contests(rows, ids, "left_semi").collect())) == [(1, 0), (1, 1)]


def test_comfort_leaves_the_candidates_in_place(spark, seq):
    """Only the comfort is brought to the contest: no exchange stands above the unfolded candidates."""
    comfort = ev.comfort_table(seq.players, profiles.actor_item_profile(seq, None))
    cands = ev.replay_candidates(seq.steps, seq.contests, seq.items)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its exchanges
    try:
        scored = ev.comfort_score(cands, comfort)
        physical = scored._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above = physical[:next(i for i, line in enumerate(physical) if "Generate explode" in line)]
    assert not [line for line in above if "Exchange" in line or "Sort" in line]
    known = {(r.contest_id, r.side, r.item_id): r.comfort for r in comfort.collect()}
    rows = scored.filter("contest_id < 40").collect()
    assert rows and all(r.score == known.get((r.contest_id, r.side, r.item_id), 0.5) for r in rows)


def test_comfort_meets_its_contest_as_lists(spark, seq):
    """A side's lists are shuffled, not their items, and the best of each item is that of the rows joined plainly."""
    table = ev.comfort_table(seq.players, profiles.actor_item_profile(seq, None))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its exchanges
    try:
        lines = table.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    unfolds = next(i for i, line in enumerate(lines) if "Generate inline" in line)
    assert not [line for line in lines[:unfolds] if "Exchange" in line or "Aggregate" in line]
    players = spark.createDataFrame([(1, 0, 7), (1, 0, 8), (1, 1, 9), (1, 0, None), (2, None, 7), (2, None, 7), (3, 0, 10)],
                                    "contest_id long, side int, account_id long")
    rates = spark.createDataFrame([(7, 1, 0.5), (7, 2, 0.25), (8, 1, 0.75), (8, 3, 0.125), (9, 2, 0.5), (9, 2, 0.625), (None, 1, 1.0)],
                                  "account_id long, item_id int, shrunk_wr double")
    assert sorted(map(tuple, ev.comfort_table(players, rates).collect()), key=str) == sorted([
        (1, 0, 1, 0.75), (1, 0, 2, 0.25), (1, 0, 3, 0.125), (1, 1, 2, 0.625), (2, None, 1, 0.5), (2, None, 2, 0.25)], key=str)


def test_documents_are_built_and_parsed_once(spark):
    """Filters on parsed fields are not pushed below the parse, where they would build and parse the document again."""
    docs = spark.range(3).selectExpr("""to_json(named_struct('match_id', id, 'picks_bans', array(named_struct('order', 1, 'hero_id', 7)),
        'radiant_gold_adv', array(1, 2))) AS raw""")
    for table in (decode.decode_steps, decode.decode_advantages):
        rows = table(parse_documents(docs, fields=["match_id", "picks_bans", "radiant_gold_adv", "radiant_xp_adv"]))
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator(") == 1
        assert sorted(r.contest_id for r in rows.collect()) == [0, 1, 2]
    broken = spark.createDataFrame([("no object",)], "raw string")
    assert parse_documents(broken, fields=["match_id", "start_time"]).collect()[0].asDict() == {"raw": "no object", "match_id": None, "start_time": None}
