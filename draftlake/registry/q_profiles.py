"""Profiles, pairs, counts, top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from draftlake.functions.scalars import won_flag
from draftlake.operators import filters, pairs, profiles, topk
from draftlake.registry.core import query
from draftlake.registry.inputs import AS_OF, line_tables, seq_tables
from draftlake.registry.sqlparts import rate_cols, shrunk, sql
from draftlake.sources import star
from draftlake.sources.tables import merge_contests

_PROFILES = {
    "team_item_profile": (profiles.team_item_profile, "team_item"),
    "pair_synergy": (pairs.pair_synergy, "synergy"),
    "pair_counter": (pairs.pair_counter, "counter"),
    "actor_team_history": (profiles.actor_team_history, "actor_team"),
    "actor_item_profile": (profiles.actor_item_profile, "actor_item"),
}


def _register(name, fn, part):
    # Both horizons over order lines; the full-draft variant over its whole history.
    query(sql(f"line_{part}", f"SELECT * FROM line_{part}"), name)(
        lambda spark, d: fn(line_tables(spark, d), AS_OF))
    query(sql(f"line_{part}_all", f"SELECT * FROM line_{part}_all"), f"{name}_all_time")(
        lambda spark, d: fn(line_tables(spark, d), None))
    query(sql(f"seq_{part}_all", f"SELECT * FROM seq_{part}_all"), f"{name}_full_drafts")(
        lambda spark, d: fn(seq_tables(spark, d), None))


for _n, (_fn, _p) in _PROFILES.items():
    _register(_n, _fn, _p)


@query(sql("line_team_item line_team_item_all", """SELECT * FROM line_team_item UNION ALL
    SELECT * FROM line_team_item_all WHERE NOT EXISTS (SELECT 1 FROM line_team_item)"""))
def profile_with_fallback(spark, d):
    t = line_tables(spark, d)
    return profiles.with_fallback(profiles.team_item_profile, t, AS_OF)


_LATER = "2031-01-01"  # a horizon that holds nothing
_FALLBACKS = {"team_item_profile": ("team_item", profiles.team_item_profile), "pair_synergy": ("synergy", pairs.pair_synergy),
              "pair_counter": ("counter", pairs.pair_counter), "actor_item_profile": ("actor_item", profiles.actor_item_profile)}


@query(sql("line_team_item_all", "SELECT * FROM line_team_item_all"))
def profile_fallback_taken(spark, d):
    return profiles.with_fallback(profiles.team_item_profile, line_tables(spark, d), _LATER)


@query(sql(" ".join(f"line_{p} line_{p}_all" for p, _ in _FALLBACKS.values()), " UNION ALL ".join(
    f"SELECT '{name}' AS view, '{at}' AS as_of, count(*) AS n, CAST(sum(games) AS BIGINT) AS games, CAST(sum(wins) AS BIGINT) AS wins FROM line_{p}{s}"
    for name, (p, _) in _FALLBACKS.items() for at, s in ((AS_OF, ""), (_LATER, "_all")))))
def fallback_views(spark, d):
    """The four aggregates over a horizon that holds contests, and over one that holds none."""
    t, out = line_tables(spark, d), None
    for name, (_, fn) in _FALLBACKS.items():
        for at in (AS_OF, _LATER):
            part = profiles.with_fallback(fn, t, at).agg(F.count(F.lit(1)).alias("n"), F.sum("games").alias("games"), F.sum("wins").alias("wins")) \
                .select(F.lit(name).alias("view"), F.lit(at).alias("as_of"), "n", "games", "wins")
            out = part if out is None else out.unionByName(part)
    return out


@query(sql("contests line_players", f"""SELECT season_id, item_id, {rate_cols(5)} FROM line_players
    WHERE won IS NOT NULL GROUP BY ALL"""))
def shrunk_rate_by_season(spark, d):
    return profiles.shrunk_rate(line_tables(spark, d).players, ["season_id", "item_id"], F.col("won"), 5)


@query(sql("comp line_steps", f"""SELECT item_id, count(*) AS picks, CAST(sum(CAST(won AS INTEGER)) AS BIGINT) AS wins,
    {shrunk(3)} AS shrunk_wr FROM (SELECT item_id, CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won
    FROM line_steps JOIN comp USING (contest_id) WHERE is_pick AND item_id > 0) WHERE won IS NOT NULL GROUP BY 1"""))
def item_global(spark, d):
    return profiles.item_global(line_tables(spark, d))


_COUNTS = """SELECT i.item_id, coalesce(picks, 0) AS picks, coalesce(wins, 0) AS wins FROM {items} i LEFT JOIN (
    SELECT item_id, count(*) AS picks, CAST(sum(CASE WHEN (side = 0 AND side0_won) OR (side = 1 AND NOT side0_won)
      THEN 1 ELSE 0 END) AS BIGINT) AS wins FROM {steps} JOIN comp USING (contest_id)
    WHERE is_pick AND item_id > 0{season} GROUP BY 1) USING (item_id)"""


@query(sql("comp line_steps line_items", _COUNTS.format(items="line_items", steps="line_steps", season="")))
def item_counts(spark, d):
    t = line_tables(spark, d)
    return profiles.item_counts(t, t.items)


@query(sql("comp seq_steps seq_items", _COUNTS.format(items="seq_items", steps="seq_steps",
                                                      season=" AND season_id = 1999")))
def item_counts_season(spark, d):
    t = seq_tables(spark, d)
    return profiles.item_counts(t, t.items, 1999)


@query(sql("comp line_steps", """SELECT count(*) AS total_picks FROM line_steps JOIN comp USING (contest_id)
    WHERE is_pick AND item_id > 0"""))
def total_picks(spark, d):
    return profiles.total_picks(line_tables(spark, d))


@query(sql("comp line_steps", """SELECT item_id, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS frequency
    FROM line_steps JOIN comp USING (contest_id) WHERE is_pick AND item_id > 0 AND season_id = 1999 GROUP BY 1"""))
def pick_frequency(spark, d):
    return profiles.pick_frequency(line_tables(spark, d), 1999)


_ACTING = """SELECT contest_id, start_time, season_id, slot, is_pick, item_id, side,
    CASE WHEN side = 0 THEN team0 ELSE team1 END AS acting_team,
    CASE WHEN side = 0 THEN team1 ELSE team0 END AS opp_team,
    CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS acting_won
    FROM line_steps JOIN contests USING (contest_id)"""


@query(sql("contests line_steps", _ACTING))
def acting_teams(spark, d):
    t = line_tables(spark, d)
    return profiles.acting_teams(t.steps, t.contests)


@query(sql("contests line_steps", f"""WITH a AS ({_ACTING}), c AS (SELECT * FROM a WHERE is_pick AND item_id > 0
      AND acting_won IS NOT NULL)
    SELECT item_id, count(*) AS picks, CAST(sum(CAST(acting_won AS INTEGER)) AS BIGINT) AS wins,
      (count(*) + 2.0::DOUBLE) / ((SELECT count(*) FROM c) + 4.0::DOUBLE) AS item_pick_rate,
      (CAST(sum(CAST(acting_won AS INTEGER)) AS BIGINT) + 10.0::DOUBLE) / (count(*) + 20.0::DOUBLE) AS item_wr,
      round(ln(1 + count(*)), 9) AS item_popularity FROM c GROUP BY 1"""))
def item_priors(spark, d):
    t = line_tables(spark, d)
    decided = profiles.acting_teams(t.steps, t.contests).filter(F.col("acting_won").isNotNull())
    return profiles.item_priors(decided).withColumn("item_popularity", F.round("item_popularity", 9))


@query(sql("line_actor_item_all", """SELECT account_id, item_id, shrunk_wr, games FROM (SELECT *,
    row_number() OVER (PARTITION BY account_id ORDER BY shrunk_wr DESC, games DESC, item_id) AS rn
    FROM line_actor_item_all) WHERE rn = 1"""))
def actor_signature(spark, d):
    return profiles.signature(profiles.actor_item_profile(line_tables(spark, d), None))


@query(sql("contests", """SELECT least(team0, team1) AS team_a, greatest(team0, team1) AS team_b, count(*) AS games,
    CAST(sum(CASE WHEN side0_won = (team0 < team1) THEN 1 ELSE 0 END) AS BIGINT) AS a_wins,
    CAST(count(*) - sum(CASE WHEN side0_won = (team0 < team1) THEN 1 ELSE 0 END) AS BIGINT) AS b_wins
    FROM contests WHERE team0 <> 0 AND team1 <> 0 AND side0_won IS NOT NULL GROUP BY 1, 2"""))
def head_to_head(spark, d):
    return profiles.head_to_head_all(star.contests(spark, d))


@query(sql("line_seats", """SELECT contest_id, side, list(account_id ORDER BY player_slot)
    FILTER (account_id IS NOT NULL) AS accounts FROM line_seats GROUP BY 1, 2""").replace(
        "list(account_id ORDER BY player_slot)\n    FILTER (account_id IS NOT NULL) AS accounts",
        "coalesce(string_agg(CAST(account_id AS VARCHAR), ',' ORDER BY player_slot), '') AS accounts"))
def rosters(spark, d):
    return profiles.rosters(star.line_players(spark, d)).select(
        "contest_id", "side", F.array_join(F.transform("accounts", lambda a: a.cast("string")), ",").alias("accounts"))


@query(sql("contests line_steps", """SELECT item_id, CAST(sum(CASE WHEN (side = 0 AND side0_won) OR
      (side = 1 AND NOT side0_won) THEN 1 ELSE 0 END) AS BIGINT) AS strict_wins,
    CAST(sum(CAST(CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS INTEGER)) AS BIGINT) AS known_wins,
    count(CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END) AS known_games, count(*) AS games
    FROM line_steps JOIN contests USING (contest_id) GROUP BY 1"""))
def side_outcomes(spark, d):
    t = line_tables(spark, d)
    rows = profiles.acting_teams(t.steps, t.contests)
    flagged = merge_contests(t.steps, t.contests.select("contest_id", "side0_won")).withColumn(
        "strict", won_flag("side", "side0_won"))
    strict = flagged.groupBy("item_id").agg(F.sum("strict").alias("strict_wins"))
    known = rows.groupBy("item_id").agg(
        F.sum(F.col("acting_won").cast("int")).alias("known_wins"),
        F.count("acting_won").alias("known_games"), F.count(F.lit(1)).alias("games"))
    return known.join(strict, "item_id")


# --- top-k -------------------------------------------------------------------------------

@query(sql("line_synergy_all", """WITH ways AS (
    SELECT item_a AS item_id, item_b AS partner_id, item_b_name AS partner_name, games, wins, shrunk_wr FROM line_synergy_all
    UNION ALL SELECT item_b, item_a, item_a_name, games, wins, shrunk_wr FROM line_synergy_all)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY shrunk_wr DESC, partner_id) AS INTEGER)
      AS rank FROM ways WHERE games >= 2) WHERE rank <= 20"""))
def top_partners(spark, d):
    return topk.top_partners(pairs.pair_synergy(line_tables(spark, d), None))


@query(sql("line_counter_all", """SELECT * FROM (SELECT item_a AS item_id, item_b AS opponent_id,
    item_b_name AS opponent_name, games, wins, shrunk_wr,
    CAST(row_number() OVER (PARTITION BY item_a ORDER BY shrunk_wr, item_b) AS INTEGER) AS rank
    FROM line_counter_all WHERE games >= 2) WHERE rank <= 20"""))
def top_counters(spark, d):
    return topk.top_counters(pairs.pair_counter(line_tables(spark, d), None))


@query(sql("line_team_item_all", """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY team_id
    ORDER BY games DESC, item_id) AS INTEGER) AS rank FROM line_team_item_all WHERE games >= 1) WHERE rank <= 50"""))
def top_team_items(spark, d):
    return topk.top_team_items(profiles.team_item_profile(line_tables(spark, d), None))


@query(sql("line_actor_item_all", """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY account_id
    ORDER BY games DESC, item_id) AS INTEGER) AS rank FROM line_actor_item_all WHERE games >= 1) WHERE rank <= 50"""))
def top_actor_items(spark, d):
    return topk.top_actor_items(profiles.actor_item_profile(line_tables(spark, d), None))


@query(sql("line_actor_team_all", """SELECT * FROM (SELECT *, last_season_id > 0 AS recent,
    CAST(row_number() OVER (PARTITION BY account_id ORDER BY games DESC, team_id) AS INTEGER) AS rank
    FROM line_actor_team_all) WHERE rank <= 10"""))
def top_actor_teams(spark, d):
    return topk.top_actor_teams(profiles.actor_team_history(line_tables(spark, d), None))


@query(sql("line_actor_team_all line_actor_item_all", """WITH i AS (SELECT account_id, count(*) AS n_items,
      string_agg(item_id || ':' || games, ',' ORDER BY rank) AS items FROM (SELECT *, row_number() OVER (
        PARTITION BY account_id ORDER BY games DESC, item_id) AS rank FROM line_actor_item_all) WHERE rank <= 50 GROUP BY 1),
    t AS (SELECT account_id, count(*) AS n_teams, string_agg(team_id || ':' || games, ',' ORDER BY rank) AS teams FROM (
        SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY games DESC, team_id) AS rank
        FROM line_actor_team_all) WHERE rank <= 10 GROUP BY 1)
    SELECT coalesce(i.account_id, t.account_id) AS account_id, n_items, items, n_teams, teams
    FROM i FULL JOIN t ON i.account_id = t.account_id"""))
def actor_cards(spark, d):
    t = line_tables(spark, d)
    cards = topk.actor_cards(profiles.actor_item_profile(t, None), profiles.actor_team_history(t, None))

    def text(col, key):
        return F.array_join(F.transform(col, lambda x: F.concat(
            x[key].cast("string"), F.lit(":"), x["games"].cast("string"))), ",")

    def length(col):
        return F.when(F.col(col).isNotNull(), F.size(col).cast("bigint"))

    return cards.select("account_id", length("items").alias("n_items"), text("items", "item_id").alias("items"),
                        length("teams").alias("n_teams"), text("teams", "team_id").alias("teams"))


@query(sql("line_team_item_all", """SELECT team_id, item_id, games, shrunk_wr FROM line_team_item_all WHERE games >= 3
    ORDER BY shrunk_wr DESC, team_id, item_id LIMIT 100"""))
def profile_report(spark, d):
    p = filters.min_games(profiles.team_item_profile(line_tables(spark, d), None), 3)
    return (p.select("team_id", "item_id", "games", "shrunk_wr")
            .orderBy(F.desc("shrunk_wr"), "team_id", "item_id").limit(100))
