"""Hot keys, invariants and the agreement of alternative execution paths, against brute force."""

import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from draftlake.operators import joins, pairs, profiles, upserts
from draftlake.operators.profiles import DraftTables
from draftlake.plans import decisions as dec
from draftlake.plans import features as feat
from draftlake.streaming.ingest import fold_contests

CONTESTS = "contest_id bigint, start_time bigint, season_id int, side0_won boolean, league_id int, lobby int, team0 bigint, team1 bigint"
STEPS = "contest_id bigint, slot int, is_pick boolean, item_id int, side int"


def tables(spark, seed=3, hot=400):
    """Forty drafts, and one contest that holds most of the rows, with repeated items."""
    rnd = random.Random(seed)
    contests = [(c, 1000 + c, 1, rnd.random() < 0.5, 1, 1, 1 + c % 5, 11 + c % 3) for c in range(41)]
    steps = []
    for c in range(40):
        items = rnd.sample(range(1, 16), 12)
        steps += [(c, s, s >= 2, items[s], s % 2) for s in range(12)]
    steps += [(40, s, True, rnd.randrange(1, 16), rnd.randrange(2)) for s in range(hot)]
    players = [(c, 128 * side + k, 100 + (c + k) % 7, rnd.randrange(1, 16), side, 1000 + c, 1, 1, 1,
                contests[c][3] if side == 0 else not contests[c][3]) for c in range(40) for side in (0, 1) for k in range(5)]
    items = [(i, f"i{i}", ["str", "agi", "int", "all"][i % 4], ["Carry"]) for i in range(1, 16)]
    return contests, steps, DraftTables(
        spark.createDataFrame(contests, CONTESTS), spark.createDataFrame(steps, STEPS),
        spark.createDataFrame(players, "contest_id bigint, player_slot int, account_id bigint, item_id int, side int, "
                                       "start_time bigint, season_id int, lobby int, league_id int, won boolean"),
        spark.createDataFrame(items, "item_id int, item_name string, primary_attr string, roles array<string>"))


def brute_pairs(contests, steps, same):
    won = {c[0]: c[3] for c in contests}
    games, wins = Counter(), Counter()
    by_contest = {}
    for c, _, pick, item, side in steps:
        if pick:
            by_contest.setdefault(c, []).append((item, side))
    for c, rows in by_contest.items():
        for (a, sa), (b, sb) in itertools.product(rows, rows):
            if (same and sa == sb and a < b) or (not same and sa != sb and a != b):
                games[a, b] += 1
                wins[a, b] += won[c] if sa == 0 else not won[c]
    return {k: (n, wins[k]) for k, n in games.items()}


def test_pairs_with_a_hot_contest(spark):
    contests, steps, t = tables(spark)
    for fn, same in ((pairs.pair_synergy, True), (pairs.pair_counter, False)):
        got = {(r["item_a"], r["item_b"]): (r["games"], r["wins"]) for r in fn(t, None).collect()}
        assert got == brute_pairs(contests, steps, same)


def test_counter_is_consistent(spark):
    _, _, t = tables(spark)
    c = {(r["item_a"], r["item_b"]): r for r in pairs.pair_counter(t, None).collect()}
    for (a, b), r in c.items():
        assert r["games"] == c[b, a]["games"] == r["wins"] + c[b, a]["wins"]


def feature_rows(spark, unknown=None):
    _, steps, t = tables(spark, hot=0)
    decided = dec.decisions(t.steps, t.contests)
    picked = decided.filter("is_pick")
    ft = feat.FeatureTables(
        t.contests, t.players, t.items, profiles.team_item_profile(t, None), pairs.pair_synergy(t, None), pairs.pair_counter(t, None),
        profiles.actor_item_profile(t, None), profiles.item_global(t), profiles.item_priors(decided), picked.agg(F.count(F.lit(1)).alias("n")))
    states = dec.decision_states(decided)
    if unknown:
        states = states.withColumn("item_id", F.when(F.col("slot") == 11, unknown).otherwise(F.col("item_id")).cast(states.schema["item_id"].dataType))
    rows = feat.candidate_features(states, ft, n=6).collect()
    return steps, {(r["contest_id"], r["slot"], r["item_id"]): r.asDict() for r in rows}


def test_items_beyond_the_catalogue_get_the_fallbacks(spark):
    _, known = feature_rows(spark)
    assert len(known) == 40 * sum(1 + min(6, 15 - s - 1) for s in range(2, 12))
    _, rows = feature_rows(spark, 600)
    odd = [r for (_, s, i), r in rows.items() if i == 600]
    assert len(odd) == 40 and {(r["hero_wr"], r["hero_meta_primary_attr"], r["label"]) for r in odd} == {(0.5, 0.0, 1.0)}
    assert {k: r for k, r in rows.items() if k[1] < 11} == {k: r for k, r in known.items() if k[1] < 11}


def test_candidates_never_see_later_slots(spark):
    steps, rows = feature_rows(spark)
    drafted = {(c, s): {i for cc, ss, _, i, _ in steps if cc == c and ss < s} for c, s, *_ in steps}
    for c, s, item in rows:
        assert item not in drafted[c, s]
    per = Counter((c, s) for c, s, _ in rows)
    assert all(n == 1 + min(6, 15 - s - 1) for (_, s), n in per.items())


def test_split_keeps_contests_whole(spark):
    frame = spark.range(2000).select(F.col("id").alias("contest_id"), F.lit(1).alias("x"))
    train, valid = dec.split_by_contest(frame.unionByName(frame))
    a, b = {r[0] for r in train.collect()}, {r[0] for r in valid.collect()}
    assert not a & b and len(a) + len(b) == 2000 and 1450 < len(a) < 1750


def test_season_at_edges(spark):
    seasons = spark.createDataFrame([(1, "a", 100), (2, "b", 10**8), (3, "c", 5 * 10**8)], "season_id int, season_name string, release_at bigint")
    times = [0, 99, 100, 10**8 - 1, 10**8, 3 * 10**8, 5 * 10**8, 4 * 10**9]
    df = spark.createDataFrame([(t,) for t in times], "t bigint")
    got = {r["t"]: r["season_at_id"] for r in joins.season_at(df, "t", seasons).collect()}
    assert [got[t] for t in times] == [None, None, 1, 1, 2, 2, 3, 3]


def test_fold_equals_sequential_upserts(spark):
    rnd = random.Random(11)
    schema = "contest_id bigint, start_time bigint, side0_won boolean, season_id int, score0 int, is_parsed boolean, batch_id int"
    rows = [(k, 1, rnd.choice([True, False, None]), rnd.randrange(9), rnd.choice([None, 1, 2, 3]), rnd.random() < 0.4, b)
            for k in range(30) for b in range(4) if rnd.random() < 0.8]
    changes = spark.createDataFrame(rows, schema)
    stored = changes.limit(0).drop("batch_id")
    for b in range(4):
        stored = upserts.upsert_contests(stored, changes.filter(F.col("batch_id") == b).drop("batch_id"))
    assert sorted(map(tuple, fold_contests(changes).collect()), key=str) == sorted(map(tuple, stored.collect()), key=str)


def test_salted_lookup_equals_a_plain_join(spark):
    rows = [(i, 7 if i % 3 else i % 11) for i in range(600)] + [(1000, None), (1001, 99)]
    df = spark.createDataFrame(rows, "id bigint, k bigint")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(11)], "k bigint, v string")
    plain = sorted(map(str, df.join(lookup, "k", "left").select("id", "k", "v").collect()))
    for hot_rows in (1, 10 ** 6):
        got = joins.salted_lookup(df, lookup, "k", "id", hot_rows).select("id", "k", "v").collect()
        assert sorted(map(str, got)) == plain
