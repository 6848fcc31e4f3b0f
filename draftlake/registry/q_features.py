"""Features, scores, recommendations, baselines and replay metrics over full drafts."""

from __future__ import annotations

from pyspark.sql import functions as F

from draftlake.functions.scalars import millionths
from draftlake.operators import pairs, profiles
from draftlake.operators.filters import competitive
from draftlake.plans import decisions as dec
from draftlake.plans import evaluation as ev
from draftlake.plans import features as feat
from draftlake.plans import models, scoring
from draftlake.plans.feature_registry import DEFAULT, FeatureRegistry
from draftlake.registry.core import query
from draftlake.registry.inputs import seq_tables
from draftlake.registry.q_drafts import _TRAIN, CANDIDATES, DECISIONS, SAMPLE_KEY
from draftlake.registry.sqlparts import shrunk, sql
from draftlake.sources.tables import spread


def feature_tables(t, decided) -> feat.FeatureTables:
    chosen = decided.filter(F.col("is_pick") & (F.col("item_id") > 0))
    return feat.FeatureTables(
        contests=dec.decided_contests(t.contests), players=t.players, items=t.items,
        team_item=profiles.team_item_profile(t, None), synergy=pairs.pair_synergy(t, None),
        counter=pairs.pair_counter(t, None), actor_item=profiles.actor_item_profile(t, None),
        item_global=profiles.item_global(t), priors=profiles.item_priors(decided),
        total_picks=chosen.agg(F.count(F.lit(1)).alias("n")))


def feature_frame(spark, d, n=dec.NEGATIVES, threat="team"):
    t = seq_tables(spark, d)
    decided = dec.decisions(t.steps, t.contests)
    return feat.candidate_features(dec.decision_states(decided), feature_tables(t, decided), n, threat=threat)


_LOOKUPS = f"""gl AS (SELECT item_id, count(*) AS picks, {shrunk(3)} AS rate FROM (SELECT item_id,
      CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won FROM seq_steps JOIN comp USING (contest_id)
      WHERE is_pick AND item_id > 0 AND side0_won IS NOT NULL) GROUP BY 1),
    pri AS (SELECT item_id, (count(*) + 2.0::DOUBLE) / ((SELECT count(*) FROM pk WHERE item_id > 0) + 4.0::DOUBLE) AS pick_rate,
      (CAST(sum(value_label) AS BIGINT) + 10.0::DOUBLE) / (count(*) + 20.0::DOUBLE) AS wr, ln(1 + count(*)) AS pop
      FROM pk WHERE item_id > 0 GROUP BY 1),
    dp AS (SELECT contest_id, slot, item_id, side FROM dec WHERE is_pick),
    ally AS (SELECT c.contest_id, c.slot, c.item_id, CAST(sum(CAST(round(coalesce(s.shrunk_wr, g.rate, 0.5::DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) / count(*) / 1000000 AS syn FROM cand c
      JOIN pk ON pk.contest_id = c.contest_id AND pk.slot = c.slot
      JOIN dp o ON o.contest_id = c.contest_id AND o.slot < c.slot AND o.side = pk.side
      LEFT JOIN seq_synergy_all s ON s.item_a = least(c.item_id, o.item_id) AND s.item_b = greatest(c.item_id, o.item_id)
      LEFT JOIN gl g ON g.item_id = o.item_id GROUP BY 1, 2, 3),
    foe AS (SELECT c.contest_id, c.slot, c.item_id, CAST(sum(CAST(round(coalesce(s.shrunk_wr, g.rate, 0.5::DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) / count(*) / 1000000 AS ctr FROM cand c
      JOIN pk ON pk.contest_id = c.contest_id AND pk.slot = c.slot
      JOIN dp o ON o.contest_id = c.contest_id AND o.slot < c.slot AND o.side <> pk.side
      LEFT JOIN seq_counter_all s ON s.item_a = c.item_id AND s.item_b = o.item_id
      LEFT JOIN gl g ON g.item_id = o.item_id GROUP BY 1, 2, 3),
    ros AS (SELECT contest_id, side, account_id FROM seq_players WHERE account_id IS NOT NULL AND won IS NOT NULL),
    com AS (SELECT c.contest_id, c.slot, c.item_id, CAST(sum(CAST(round(coalesce(a.shrunk_wr, g.rate, 0.5::DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) / count(*) / 1000000 AS comfort FROM cand c
      JOIN pk ON pk.contest_id = c.contest_id AND pk.slot = c.slot
      JOIN ros r ON r.contest_id = c.contest_id AND r.side = pk.side
      LEFT JOIN seq_actor_item_all a ON a.account_id = r.account_id AND a.item_id = c.item_id
      LEFT JOIN gl g ON g.item_id = c.item_id GROUP BY 1, 2, 3),
    best AS (SELECT account_id, max(shrunk_wr) AS b FROM seq_actor_item_all GROUP BY 1),
    thr AS (SELECT contest_id, side, CAST(sum(CAST(round(coalesce(b, 0.5::DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) / count(*) / 1000000 AS threat FROM ros LEFT JOIN best USING (account_id) GROUP BY 1, 2),
    cx AS (SELECT p.contest_id, p.slot, count_if(o.side = p.side) AS tp, count_if(o.side <> p.side) AS ep
      FROM pk p LEFT JOIN dp o ON o.contest_id = p.contest_id AND o.slot < p.slot GROUP BY 1, 2),
    f0 AS (SELECT c.contest_id, c.slot, c.item_id, c.label, pk.side, coalesce(tp, 0) AS tp, coalesce(ep, 0) AS ep,
      coalesce(t.games, gl.picks, 0)::DOUBLE AS team_picks, coalesce(t.shrunk_wr, gl.rate, 0.5::DOUBLE) AS team_wr_shrunk,
      coalesce(syn, 0.5::DOUBLE) AS mean_syn_with_allies, coalesce(ctr, 0.5::DOUBLE) AS mean_counter_vs_enemies,
      CASE primary_attr WHEN 'str' THEN 1 WHEN 'agi' THEN 2 WHEN 'int' THEN 3 WHEN 'all' THEN 4 ELSE 0 END AS attr,
      coalesce(len(roles), 0)::DOUBLE AS hero_meta_role_count, coalesce(comfort, 0.5::DOUBLE) AS player_comfort,
      coalesce(threat, 0.5::DOUBLE) AS roster_threat,
      CASE WHEN o.games >= 3 THEN o.shrunk_wr ELSE 0.0::DOUBLE END AS team_threat,
      coalesce(pick_rate, 2.0::DOUBLE / ((SELECT count(*) FROM pk WHERE item_id > 0) + 4.0::DOUBLE)) AS hero_pick_rate,
      coalesce(wr, 0.5::DOUBLE) AS hero_wr, round(coalesce(pop, 0), 6) AS hero_popularity
      FROM cand c JOIN pk ON pk.contest_id = c.contest_id AND pk.slot = c.slot
      LEFT JOIN cx ON cx.contest_id = c.contest_id AND cx.slot = c.slot
      LEFT JOIN seq_team_item_all t ON t.team_id = pk.acting_team AND t.item_id = c.item_id
      LEFT JOIN seq_team_item_all o ON o.team_id = pk.opp_team AND o.item_id = c.item_id
      LEFT JOIN gl ON gl.item_id = c.item_id LEFT JOIN pri ON pri.item_id = c.item_id
      LEFT JOIN seq_items i ON i.item_id = c.item_id
      LEFT JOIN ally ON ally.contest_id = c.contest_id AND ally.slot = c.slot AND ally.item_id = c.item_id
      LEFT JOIN foe ON foe.contest_id = c.contest_id AND foe.slot = c.slot AND foe.item_id = c.item_id
      LEFT JOIN com ON com.contest_id = c.contest_id AND com.slot = c.slot AND com.item_id = c.item_id
      LEFT JOIN thr ON thr.contest_id = c.contest_id AND thr.side = 1 - pk.side),
    f AS (SELECT contest_id, slot, item_id, label, team_picks, team_wr_shrunk, mean_syn_with_allies, mean_counter_vs_enemies,
      attr::DOUBLE AS hero_meta_primary_attr, hero_meta_role_count, player_comfort, {{threat}} AS star_threat,
      hero_pick_rate, hero_wr, hero_popularity, s AS attr_is_str, a AS attr_is_agi, i AS attr_is_int,
      tp * greatest(i * 0.5::DOUBLE, a * 0.3::DOUBLE, s * 0.2::DOUBLE) AS attr_fit_score, slot / 30.0::DOUBLE AS draft_slot_norm,
      1.0::DOUBLE AS is_pick_phase, tp::DOUBLE AS team_picks_before, ep::DOUBLE AS enemy_picks_before,
      CASE WHEN tp = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS is_first_pick, CASE WHEN tp = 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS is_last_pick,
      CASE WHEN ep > tp THEN 1.0 ELSE 0.0 END::DOUBLE AS is_counter_phase,
      greatest(least(5 - tp, 5), 0)::DOUBLE AS remaining_team_picks,
      greatest(least((tp + ep) / 10.0::DOUBLE, 1.0::DOUBLE), 0.0::DOUBLE) AS draft_progress
      FROM (SELECT *, CASE WHEN attr IN (1, 4) THEN 1.0 ELSE 0.0 END::DOUBLE AS s,
        CASE WHEN attr IN (2, 4) THEN 1.0 ELSE 0.0 END::DOUBLE AS a, CASE WHEN attr IN (3, 4) THEN 1.0 ELSE 0.0 END::DOUBLE AS i FROM f0))"""
_NEEDS = "comp seq_steps seq_items seq_synergy_all seq_counter_all seq_actor_item_all seq_team_item_all seq_players"
_ALL_LEGAL = """pk AS (SELECT * FROM dec WHERE is_pick),
    cand AS (SELECT pk.contest_id, pk.slot, it.item_id, CASE WHEN it.item_id = pk.item_id THEN 1.0 ELSE 0.0 END::DOUBLE AS label
      FROM pk, seq_items it WHERE it.item_id = pk.item_id OR NOT EXISTS (
      SELECT 1 FROM dec o WHERE o.contest_id = pk.contest_id AND o.slot < pk.slot AND o.item_id = it.item_id))"""


def _feature_sql(body: str, threat: str = "team_threat", legal: bool = False) -> str:
    cands = _ALL_LEGAL if legal else CANDIDATES.format(items="seq_items")
    return sql(_NEEDS, f"WITH {DECISIONS.format(steps='seq_steps', season='')}, {cands}, "
                       f"{_LOOKUPS.format(threat=threat)} {body}")


# Sums of millionths are exact, whatever the order of the rows.
_MEANS_SQL = ", ".join(f"CAST(sum(CAST(round({f} * 1000000) AS BIGINT)) AS BIGINT) AS {f}" for f in feat.FEATURES)


def _millionths(c):
    return F.sum(millionths(c))


def _means():
    return [_millionths(F.col(f)).alias(f) for f in feat.FEATURES]


@query(_feature_sql(f"SELECT contest_id, slot, label, count(*) AS n, {_MEANS_SQL} FROM f GROUP BY 1, 2, 3"))
def candidate_features(spark, d):
    """All 24 features: of the chosen item of every decision, and summed over the others."""
    return feature_frame(spark, d).groupBy("contest_id", "slot", "label").agg(F.count(F.lit(1)).alias("n"), *_means())


_ASKED = ["hero_wr", "mean_counter_vs_enemies", "team_picks_before", "rate_gap"]


@query(_feature_sql(f"""SELECT contest_id, slot, item_id, label, {", ".join(f"CAST(round({f} * 1000000) AS BIGINT) AS {f}" for f in _ASKED)}
    FROM (SELECT *, abs(hero_wr - coalesce(best, 0.0::DOUBLE)) AS rate_gap FROM f LEFT JOIN (SELECT item_id, max(shrunk_wr) AS best
      FROM seq_team_item_all GROUP BY 1) b USING (item_id)) WHERE label > 0"""))
def chosen_features(spark, d):
    """Three features asked for by name and a user's own one with an input of its own, for the chosen items."""
    own = FeatureRegistry(DEFAULT)
    own.register_input("team_best", lambda cands, ft: cands.join(
        ft.team_item.groupBy("item_id").agg(F.max("shrunk_wr").alias("best")), "item_id", "left"))
    own.register("rate_gap", lambda ft: F.abs(F.coalesce("item_wr", F.lit(0.5)) - F.coalesce("best", F.lit(0.0))), "priors", "team_best")
    t = seq_tables(spark, d)
    decided = dec.decisions(t.steps, t.contests)
    frame = feat.candidate_features(dec.decision_states(decided), feature_tables(t, decided), 0, features=_ASKED, registry=own)
    return frame.select("contest_id", "slot", "item_id", "label", *[millionths(F.col(f)).alias(f) for f in _ASKED])


@query(_feature_sql(f"SELECT item_id, label, count(*) AS n, {_MEANS_SQL} FROM f GROUP BY 1, 2", "roster_threat"))
def candidate_features_roster_threat(spark, d):
    """The training variant of the opponent threat, summed per item and label."""
    return feature_frame(spark, d, threat="roster").groupBy("item_id", "label").agg(F.count(F.lit(1)).alias("n"), *_means())


# Weights of the linear score, stated here for the SQL on its own.
_WEIGHTS = [
    ("team_picks", 0.002), ("team_wr_shrunk", 0.30), ("mean_syn_with_allies", 0.25), ("mean_counter_vs_enemies", 0.20),
    ("hero_meta_primary_attr", 0.02), ("hero_meta_role_count", 0.05), ("player_comfort", 0.15), ("star_threat", -0.10),
    ("hero_pick_rate", 0.08), ("hero_wr", 0.12), ("hero_popularity", 0.02), ("attr_is_str", 0.005), ("attr_is_agi", 0.005),
    ("attr_is_int", 0.005), ("attr_fit_score", 0.04), ("draft_slot_norm", 0.005), ("is_pick_phase", 0.01),
    ("team_picks_before", 0.005), ("enemy_picks_before", -0.005), ("is_first_pick", 0.02), ("is_last_pick", 0.005),
    ("is_counter_phase", 0.005), ("remaining_team_picks", 0.005), ("draft_progress", -0.005),
]
_SCORE = "0.5::DOUBLE" + "".join(f" + {f} * {w}::DOUBLE" for f, w in _WEIGHTS)


@query(_feature_sql(f"""SELECT item_id, count(*) AS n, CAST(sum(CAST(round(score * 1000000) AS BIGINT)) AS BIGINT) AS score_sum,
    CAST(round(max(score) * 1000000) AS BIGINT) AS best
    FROM (SELECT *, {_SCORE} AS score FROM f) GROUP BY 1"""))
def linear_score(spark, d):
    return scoring.linear_score(feature_frame(spark, d)).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"), _millionths(F.col("score")).alias("score_sum"),
        millionths(F.max("score")).alias("best"))


_PARTS = "[" + ", ".join(f"{{'f': '{f}', 'd': {f} * {w}::DOUBLE}}" for f, w in _WEIGHTS) + "]"


@query(_feature_sql(f"""SELECT x.f AS factor, count(*) FILTER (x.d > 0.1) AS n_reasons, count(*) FILTER (x.d < -0.05) AS n_risks
    FROM (SELECT unnest({_PARTS}) AS x FROM f) WHERE x.d > 0.1 OR x.d < -0.05 GROUP BY 1"""))
def explanations(spark, d):
    noted = scoring.explain(feature_frame(spark, d)).select(F.explode(F.concat("reasons", "risks")).alias("x"))
    return noted.groupBy(F.col("x.factor").alias("factor")).agg(
        F.count_if(F.col("x.delta") > 0).alias("n_reasons"), F.count_if(F.col("x.delta") < 0).alias("n_risks"))


_BEST = f"""SELECT contest_id, slot, CAST(rank AS INTEGER) AS rank, item_id, item_name, CAST(round(score * 1000000) AS BIGINT) AS score_ppm,
      len(list_filter({_PARTS}, lambda p: p.d > 0.1)) AS n_reasons, len(list_filter({_PARTS}, lambda p: p.d < -0.05)) AS n_risks FROM (
      SELECT *, row_number() OVER (PARTITION BY contest_id, slot ORDER BY score DESC, item_id) AS rank
      FROM (SELECT *, {_SCORE} AS score FROM f)) JOIN seq_items USING (item_id) WHERE rank <= 10"""


def _shown(best):
    return best.select("contest_id", "slot", "rank", "item_id", "item_name", millionths(F.col("score")).alias("score_ppm"),
                       F.size("reasons").cast("bigint").alias("n_reasons"), F.size("risks").cast("bigint").alias("n_risks"))


@query(_feature_sql(_BEST, legal=True))
def recommendations(spark, d):
    """Top ten of the whole legal pool for every pick."""
    scored = scoring.linear_score(feature_frame(spark, d, n=None))
    return _shown(scoring.recommend(scored, seq_tables(spark, d).items))


# The pick slots of the standard draft; each contest asks for one of them.
_PICK_SLOTS = (7, 8, 12, 13, 14, 15, 16, 17, 22, 23)
_ASKED_SLOT = "CASE contest_id % 10 " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(_PICK_SLOTS)) + " END"


@query(_feature_sql(f"SELECT * FROM ({_BEST}) WHERE slot = {_ASKED_SLOT}", legal=True))
def recommend_requests(spark, d):
    """Top ten for requested positions that carry their own teams, rosters, picks and bans.

    The requests restate one position of each decided contest, so the answers are those of the stored draft.
    """
    t = seq_tables(spark, d)
    decided = dec.decisions(t.steps, t.contests)
    asked = F.expr(_ASKED_SLOT)
    turns = decided.groupBy("contest_id").agg(F.bool_or((F.col("slot") == asked) & F.col("is_pick")).alias("asks"), *[
        F.collect_list(F.when((F.col("slot") < asked) & (F.col("is_pick") == pick) & (F.col("side") == s), F.col("item_id"))).alias(f"{name}{s}")
        for name, pick in (("picks", True), ("bans", False)) for s in (0, 1)])
    seats = feat.stored_seats(t.players).groupBy("contest_id").agg(*[
        F.collect_list(F.when(F.col("side") == s, F.col("account_id"))).alias(f"roster{s}") for s in (0, 1)])
    requests = turns.filter("asks").drop("asks").join(seats, "contest_id", "left").join(
        t.contests.select("contest_id", "team0", "team1"), "contest_id").withColumn("slot", asked + 1)
    return _shown(scoring.recommend_requests(requests, feature_tables(t, decided)))


_RANK_KEY = f"({SAMPLE_KEY}) / 2147483647.0::DOUBLE"


@query(sql("comp seq_steps seq_items", f"""WITH {DECISIONS.format(steps='seq_steps', season='')},
    {CANDIDATES.format(items='seq_items')}, im AS (SELECT contest_id, slot, item_id, item_id / 127.0::DOUBLE AS score FROM cand),
    va AS (SELECT contest_id, slot, item_id, (item_id * 3 % 127) / 127.0::DOUBLE AS score FROM cand WHERE item_id % 5 <> 0)
    SELECT im.item_id, count(*) AS n, CAST(sum(CAST(round((0.7::DOUBLE * im.score
      + 0.3::DOUBLE * coalesce(va.score, im.score)) * 1000000) AS BIGINT)) AS BIGINT) AS score_sum
    FROM im LEFT JOIN va ON va.contest_id = im.contest_id AND va.slot = im.slot AND va.item_id = im.item_id GROUP BY 1"""))
def ensemble(spark, d):
    """Mix of two scores of every candidate; items divisible by five have no value score."""
    t = seq_tables(spark, d)
    states = dec.decision_states(dec.decisions(t.steps, t.contests)).filter("is_pick").select("contest_id", "slot", "is_pick", "item_id", "drafted")
    # Decisions are dealt before they unfold thirty-fold, so that the two scores meet in place.
    c = dec.candidates(spread(states, "contest_id", "slot"), t.items).select("contest_id", "slot", "item_id")
    imitation = c.withColumn("score", F.col("item_id") / 127.0)
    value = c.filter("item_id % 5 <> 0").withColumn("score", F.col("item_id") * 3 % 127 / 127.0)
    mixed = scoring.ensemble(imitation, value, ["contest_id", "slot", "item_id"], dealt_by=["contest_id", "slot"])
    return mixed.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), _millionths(F.col("score")).alias("score_sum"))


# --- baselines and replay ----------------------------------------------------------------

_REPLAY = """sw AS (SELECT *, CASE WHEN is_pick <> lag(is_pick) OVER (PARTITION BY contest_id ORDER BY slot) THEN 1 ELSE 0 END
      AS s, first_value(is_pick) OVER (PARTITION BY contest_id ORDER BY slot) AS opens FROM seq_steps
      SEMI JOIN comp USING (contest_id)),
    ph AS (SELECT *, CASE WHEN is_pick THEN 'pick_' ELSE 'ban_' END || ((CAST(sum(s) OVER (PARTITION BY contest_id
      ORDER BY slot ROWS UNBOUNDED PRECEDING) AS INTEGER) + CAST(opens AS INTEGER)) // 2 + 1) AS phase_name FROM sw),
    pool AS (SELECT p.contest_id, p.slot, p.side, p.phase_name, p.item_id AS true_item, i.item_id FROM ph p, seq_items i
      WHERE p.is_pick AND NOT EXISTS (SELECT 1 FROM ph o WHERE o.contest_id = p.contest_id AND o.slot < p.slot
        AND o.item_id = i.item_id)),
    scored AS ({score}),
    truth AS (SELECT contest_id, slot, score AS ts FROM scored WHERE item_id = true_item),
    ranked AS (SELECT s.contest_id, s.slot, s.phase_name, 1 + count_if(s.score > t.ts OR (s.score = t.ts
      AND s.item_id < s.true_item)) AS rank FROM scored s JOIN truth t USING (contest_id, slot) GROUP BY 1, 2, 3)"""
_METRICS = """SELECT coalesce(phase_name, 'overall') AS phase_name, count(*) AS total, count_if(rank = 1) AS correct,
    round(avg(CASE WHEN rank <= 1 THEN 1.0::DOUBLE ELSE 0 END), 9) AS recall1,
    round(avg(CASE WHEN rank <= 3 THEN 1.0::DOUBLE ELSE 0 END), 9) AS recall3,
    round(avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE ELSE 0 END), 9) AS recall5,
    round(avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE / log2(rank + 1.0::DOUBLE) ELSE 0 END), 9) AS ndcg10
    FROM ranked GROUP BY ROLLUP (phase_name)"""


def _replay_sql(score: str, needs: str = "") -> str:
    return sql(f"comp seq_steps seq_items {needs}", f"WITH {_REPLAY.format(score=score)} {_METRICS}")


def _rounded(m):
    return m.select("phase_name", "total", "correct", *[
        F.round(c, 9).alias(c) for c in ("recall1", "recall3", "recall5", "ndcg10")])


def _replayed(t, scorer, rescore=False):
    return _rounded(ev.replay(t.steps, ev.replay_contests(competitive(t.contests)), t.items, scorer, rescore))


_RANDOM = f"""SELECT *, {_RANK_KEY} AS score FROM (SELECT *, item_id AS i,
    (contest_id % 2147483647 * 48271 + slot * 16807 + item_id * 69621 + 42) % 2147483647 AS k1 FROM pool)"""


@query(_replay_sql(_RANDOM))
def replay_random(spark, d):
    return _replayed(seq_tables(spark, d), ev.random_score, rescore=True)


@query(_replay_sql("""SELECT p.*, coalesce(f.frequency, 0.0::DOUBLE) AS score FROM pool p LEFT JOIN (SELECT item_id,
    count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS frequency FROM seq_steps JOIN comp USING (contest_id)
    WHERE is_pick AND item_id > 0 GROUP BY 1) f USING (item_id)"""))
def replay_frequency(spark, d):
    t = seq_tables(spark, d)
    return _replayed(t, lambda c: ev.frequency_score(c, profiles.pick_frequency(t, None)), rescore=True)


@query(_replay_sql("""SELECT p.*, coalesce(c.comfort, 0.5::DOUBLE) AS score FROM pool p LEFT JOIN (
    SELECT r.contest_id, r.side, a.item_id, max(a.shrunk_wr) AS comfort FROM seq_seats r JOIN seq_actor_item_all a
    ON a.account_id = r.account_id GROUP BY 1, 2, 3) c USING (contest_id, side, item_id)""", "seq_actor_item_all"))
def replay_comfort(spark, d):
    t = seq_tables(spark, d)
    comfort = ev.comfort_table(t.players, profiles.actor_item_profile(t, None))
    return _replayed(t, lambda c: ev.comfort_score(c, comfort), rescore=True)


@query(_feature_sql(f"""SELECT count(*) AS decisions, round(avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE ELSE 0 END), 9) AS recall
    FROM (SELECT contest_id, slot, label, row_number() OVER (PARTITION BY contest_id, slot ORDER BY score DESC, item_id) AS rank
    FROM (SELECT *, {_SCORE} AS score FROM f)) WHERE label > 0"""))
def sampled_recall(spark, d):
    out = ev.sampled_recall(scoring.linear_score(feature_frame(spark, d)))
    return out.select("decisions", F.round("recall", 9).alias("recall"))


# --- what the models learn from ------------------------------------------------------------

_KEY1 = "(contest_id % 2147483647 * 48271 + slot * 16807 + item_id * 69621 + 42) % 2147483647"
_SIGN = f"CASE WHEN (({_KEY1}) * ({_KEY1}) + item_id) % 2147483647 % 2 = 0 THEN 1 ELSE -1 END"
_DIFFS = ["team_picks", "mean_syn_with_allies", "player_comfort", "hero_wr"]


@query(_feature_sql(f"""SELECT contest_id, slot, count(*) AS n, count_if(sign > 0) AS n_first,
      {", ".join(f"CAST(sum(sign * (CAST(round(c_{x} * 1000000) AS BIGINT) - CAST(round({x} * 1000000) AS BIGINT))) AS BIGINT) AS {x}" for x in _DIFFS)}
    FROM (SELECT f.*, {", ".join(f"c.{x} AS c_{x}" for x in _DIFFS)}, {_SIGN.replace("contest_id", "f.contest_id").replace("slot", "f.slot").replace("item_id", "f.item_id")} AS sign
      FROM f JOIN (SELECT * FROM f WHERE label > 0) c ON c.contest_id = f.contest_id AND c.slot = f.slot WHERE f.label = 0) GROUP BY 1, 2"""))
def ranking_pairs(spark, d):
    """The ranker's pairs: chosen minus other candidate with a seeded sign, summed per decision."""
    frame = feature_frame(spark, d).withColumns({x: millionths(F.col(x)).cast("double") for x in _DIFFS})
    diffs = models.pairwise_differences(frame, _DIFFS)
    return diffs.groupBy("contest_id", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n_first"), *[F.sum(x).cast("bigint").alias(x) for x in _DIFFS])


@query(sql("comp seq_steps", f"""WITH {DECISIONS.format(steps='seq_steps', season='')}
    SELECT contest_id, slot, item_id, CAST(acting_won AS DOUBLE) AS value_label, NOT ({_TRAIN}) AS validation FROM dec WHERE is_pick"""))
def value_examples(spark, d):
    """The win classifier's examples: every pick with the outcome of its side and the side of the split it is on."""
    return models.value_frame(feature_frame(spark, d, n=0)).select("contest_id", "slot", "item_id", "value_label", "validation")
