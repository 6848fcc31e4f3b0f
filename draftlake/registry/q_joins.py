"""Filters, joins, reports, upserts, maintenance, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from draftlake.functions.scalars import millionths
from draftlake.operators import filters, joins, maintenance, pairs, profiles, reports, upserts
from draftlake.plans import decisions as dec
from draftlake.plans import refresh
from draftlake.registry.core import query
from draftlake.registry.inputs import AS_OF, line_tables, seq_tables
from draftlake.registry.q_decode import docs
from draftlake.registry.q_drafts import DECISIONS
from draftlake.registry.sqlparts import HORIZON, sql
from draftlake.sources import star
from draftlake.sources.tables import load, table_counts
from draftlake.streaming import quarantine as qt

_TEAMS = "coalesce(team0 <> 0 AND team1 <> 0, false)"


# --- filters ------------------------------------------------------------------------------

@query(sql("contests", "SELECT * FROM contests"))
def contest_scan(spark, d):
    return star.contests(spark, d)


@query(sql("comp", f"SELECT * FROM comp WHERE {_TEAMS}"))
def competitive_contests(spark, d):
    return filters.both_teams(filters.competitive(star.contests(spark, d)))


@query(sql("contests", f"SELECT * FROM contests WHERE start_time >= {HORIZON}"))
def within_horizon(spark, d):
    return filters.within_months(star.contests(spark, d), "start_time", AS_OF, 6)


@query(sql("line_players", """SELECT * FROM line_players WHERE lobby IN (1, 2, 5, 6, 7) AND account_id IS NOT NULL
    AND won IS NOT NULL AND item_id > 0"""))
def comfort_eligible(spark, d):
    return filters.comfort_eligible(line_tables(spark, d).players)


@query(sql("contests", f"""SELECT contest_id, start_time FROM contests WHERE lobby IN (1, 2, 6)
    AND start_time >= CAST(epoch(DATE '{AS_OF}' - INTERVAL 180 DAY) AS BIGINT)
    ORDER BY start_time DESC, contest_id DESC LIMIT 10000"""))
def recent_contests(spark, d):
    return filters.recent_contests(star.contests(spark, d), AS_OF, limit=10_000)


@query(sql("contests", "SELECT contest_id, start_time FROM contests WHERE season_id = 1997"))
def season_filter(spark, d):
    return filters.in_season(star.contests(spark, d), 1997).select("contest_id", "start_time")


@query(sql("line_steps contests", """SELECT * FROM line_steps WHERE contest_id IN (SELECT contest_id FROM contests WHERE NOT side0_won)"""))
def key_set_filter(spark, d):
    keys = star.contests(spark, d).filter(~F.col("side0_won"))
    return filters.by_keys(star.line_steps(spark, d), keys, "contest_id")


@query(sql("line_steps", "SELECT DISTINCT item_id FROM line_steps WHERE item_id > 0"))
def item_universe(spark, d):
    return star.line_steps(spark, d).filter("item_id > 0").select("item_id").distinct()


# --- joins --------------------------------------------------------------------------------

@query(sql("contests", """SELECT contest_id, start_time, CASE WHEN league_id <> 0 THEN league_id END AS league_id, team_id, side, won FROM (
    SELECT *, team0 AS team_id, 0 AS side, side0_won AS won FROM contests UNION ALL
    SELECT *, team1, 1, NOT side0_won FROM contests) WHERE team_id <> 0"""))
def team_contests(spark, d):
    return joins.team_contests(star.contests(spark, d))


@query("""WITH s AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), r AS (SELECT y, make_timestamp(y, 1, 1, 0, 0, 0) AS a FROM s)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST((SELECT max(y) FROM r WHERE a <= l_shipdate) AS INTEGER) AS season_at_id FROM lineitem""")
def season_at(spark, d):
    """Season in force at every ship date; dates before the first season get none."""
    from draftlake.functions.scalars import epoch_of
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", epoch_of("l_shipdate").alias("t"))
    return joins.season_at(lines, "t", star.seasons(spark, d)).drop("t")


@query(sql("seasons", """SELECT season_id, release_at AS start_at, coalesce(lead(release_at) OVER (ORDER BY release_at) - 1, 9223372036854775807)
    AS end_at FROM seasons"""))
def season_ranges(spark, d):
    from draftlake.operators.windows import season_ranges as ranges
    return ranges(star.seasons(spark, d))


@query(sql("contests", "SELECT contest_id, start_time FROM contests WHERE year(to_timestamp(start_time)) = 1999"))
def contests_of_season(spark, d):
    c = joins.contests_of_season(star.contests(spark, d), star.seasons(spark, d), 1999)
    return c.select("contest_id", "start_time")


@query(sql("contests line_steps", """SELECT contest_id FROM line_steps SEMI JOIN (SELECT contest_id FROM contests
    WHERE season_id = (SELECT max(season_id) FROM contests) ORDER BY contest_id LIMIT 5000) USING (contest_id)"""))
def newest_season_steps(spark, d):
    from draftlake.operators.drafts import newest_season_sample
    t = line_tables(spark, d)
    return t.steps.join(newest_season_sample(t.contests, 5000), "contest_id", "left_semi").select("contest_id")


def _prior(same: bool) -> str:
    return sql("line_steps", f"""SELECT a.contest_id, a.slot, a.side, a.item_id, b.slot AS other_slot, b.item_id AS other_item
        FROM line_steps a JOIN line_steps b ON a.contest_id = b.contest_id AND a.side {'=' if same else '<>'} b.side
        AND b.slot < a.slot WHERE a.is_pick AND b.is_pick""")


@query(_prior(True))
def prior_selections_same_side(spark, d):
    return joins.prior_selections(star.line_steps(spark, d), True)


@query(_prior(False))
def prior_selections_other_side(spark, d):
    return joins.prior_selections(star.line_steps(spark, d), False)


@query(sql("line_steps line_synergy_all", """SELECT a.contest_id, a.slot, a.item_id, b.item_id AS other_item, s.shrunk_wr AS pair_wr
    FROM line_steps a JOIN line_steps b ON a.contest_id = b.contest_id AND a.side = b.side AND b.slot < a.slot
    LEFT JOIN line_synergy_all s ON s.item_a = least(a.item_id, b.item_id) AND s.item_b = greatest(a.item_id, b.item_id)
    WHERE a.is_pick AND b.is_pick"""))
def pair_lookup(spark, d):
    t = line_tables(spark, d)
    rows = joins.prior_selections(t.steps, True).select("contest_id", "slot", "item_id", "other_item")
    return pairs.pair_lookup(rows, "item_id", "other_item", pairs.pair_synergy(t, None))


_OWN = """own AS (SELECT item_id, (sum(CAST(won AS INTEGER))::DOUBLE + 3.0::DOUBLE) / (count(*) + 6.0::DOUBLE) AS rate FROM (
    SELECT item_id, CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS won FROM line_steps JOIN comp USING (contest_id)
    WHERE is_pick AND item_id > 0 AND side0_won IS NOT NULL) GROUP BY 1)"""


@query(sql("comp line_steps line_synergy_all", f"""WITH {_OWN}, p AS (SELECT * FROM line_steps WHERE is_pick)
    SELECT p.contest_id, p.slot, p.item_id, coalesce(CAST(sum(CAST(round(coalesce(s.shrunk_wr, own.rate, 0.5::DOUBLE) * 1000000)
      AS BIGINT)) FILTER (b.item_id IS NOT NULL) AS BIGINT) / count(b.item_id) / 1000000, 0.5::DOUBLE) AS mean_syn
    FROM p LEFT JOIN p b ON b.contest_id = p.contest_id AND b.side = p.side AND b.slot < p.slot
    LEFT JOIN line_synergy_all s ON s.item_a = least(p.item_id, b.item_id) AND s.item_b = greatest(p.item_id, b.item_id)
    LEFT JOIN own ON own.item_id = b.item_id GROUP BY 1, 2, 3"""))
def mean_partner_rate(spark, d):
    """Mean synergy of every pick with its side's earlier picks, by joins (any catalogue size)."""
    from draftlake.operators.windows import draft_state
    t = line_tables(spark, d)
    picked = draft_state(t.steps).filter("is_pick").select("contest_id", "slot", "item_id", "allies")
    rates = pairs.both_directions(pairs.pair_synergy(t, None)).select("item_id", "partner_id", F.col("shrunk_wr").alias("rate"))
    return pairs.mean_partner_rate(picked, ["contest_id", "slot"], "allies", rates, profiles.item_global(t), "mean_syn").drop("allies")


@query(sql("line_players line_actor_item_all", """SELECT item_id, count(*) AS n, CAST(sum(CAST(round(comfort * 1000000) AS BIGINT)) AS BIGINT) AS comfort_sum FROM (
    SELECT contest_id, side, item_id, max(a.shrunk_wr) AS comfort FROM (
      SELECT contest_id, side, account_id FROM line_players WHERE account_id IS NOT NULL) r JOIN line_actor_item_all a
      USING (account_id) GROUP BY 1, 2, 3) GROUP BY 1"""))
def roster_comfort(spark, d):
    from draftlake.plans.evaluation import comfort_table
    t = line_tables(spark, d)
    best = comfort_table(t.players, profiles.actor_item_profile(t, None))
    return best.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.sum(millionths("comfort")).alias("comfort_sum"))


@query(sql("comp line_steps line_team_item_all", """WITH gl AS (SELECT item_id, count(*) AS picks FROM line_steps JOIN comp
      USING (contest_id) WHERE is_pick AND item_id > 0 AND side0_won IS NOT NULL GROUP BY 1),
    k AS (SELECT t.team_id, i.item_id FROM (SELECT DISTINCT team0 AS team_id FROM comp) t, (SELECT DISTINCT item_id FROM line_steps) i)
    SELECT k.item_id, CAST(sum(coalesce(p.games, gl.picks, 0)) AS BIGINT) AS games, CAST(sum(CAST(round(coalesce(p.shrunk_wr,
      0.5::DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) AS rate_sum FROM k LEFT JOIN line_team_item_all p ON p.team_id = k.team_id
      AND p.item_id = k.item_id LEFT JOIN gl ON gl.item_id = k.item_id GROUP BY 1"""))
def left_fill(spark, d):
    """Every team with every item, missing profile rows filled from the item and then a constant."""
    t = line_tables(spark, d)
    seen = t.steps.agg(F.collect_set("item_id").alias("ids"))  # at most the 25 brands
    teams = filters.competitive(t.contests).select(F.col("team0").alias("team_id")).distinct()
    grid = teams.select("team_id", F.explode(seen.scalar()).alias("item_id"))
    own = profiles.item_global(t).select("item_id", F.col("picks").alias("own_picks"))
    keyed = grid.join(own, "item_id", "left")
    filled = joins.left_fill(keyed, profiles.team_item_profile(t, None), ["team_id", "item_id"],
                             {"games": (F.col("own_picks"), 0), "shrunk_wr": (None, 0.5)})
    return filled.groupBy("item_id").agg(
        F.sum("games").alias("games"), F.sum(millionths("shrunk_wr")).alias("rate_sum"))


_PARSED = "*, season_id % 2 = 0 AS is_parsed"


@query(sql("contests", f"""WITH c AS (SELECT {_PARSED} FROM contests WHERE side0_won IS NOT NULL)
    SELECT l_orderkey AS contest_id, l_linenumber AS line FROM lineitem LEFT JOIN c ON contest_id = l_orderkey
    WHERE NOT coalesce(is_parsed, false)"""))
def needs_work(spark, d):
    known = star.contests(spark, d).filter("side0_won is not null").withColumn("is_parsed", F.col("season_id") % 2 == 0)
    refs = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("contest_id"), F.col("l_linenumber").alias("line"))
    return joins.needs_work(refs, known)


@query(sql("contests", """SELECT contest_id, start_time FROM contests WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = contest_id)
    AND side0_won"""))
def known_refs(spark, d):
    c = star.contests(spark, d)
    held = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("contest_id")).distinct()
    refs = c.filter("side0_won").join(held, "contest_id", "left_semi")
    return joins.known_refs(c, refs).select("contest_id", "start_time")


@query("""SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey <> 0 AND l_partkey NOT IN (
    SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY')""")
def missing_keys(spark, d):
    dim = load(spark, d, "part").filter("p_type <> 'ECONOMY'")
    return joins.missing_keys(load(spark, d, "lineitem"), "l_partkey", dim, "p_partkey")


@query(sql("contests line_steps", """SELECT count(*) AS joinable_picks FROM line_steps s JOIN contests c USING (contest_id)
    WHERE is_pick AND league_id > 0 AND CASE WHEN side = 0 THEN team0 ELSE team1 END <> 0"""))
def joinable_picks(spark, d):
    t = line_tables(spark, d)
    return joins.joinable_count(t.steps, t.contests, joins.team_contests(t.contests))


@query(sql("contests", """WITH s AS (SELECT contest_id, team0 AS team_id, 0 AS side, side0_won AS won FROM contests WHERE team0 <> 0
      UNION ALL SELECT contest_id, team1, 1, NOT side0_won FROM contests WHERE team1 <> 0)
    SELECT contest_id, team_id, side FROM s WHERE EXISTS (SELECT 1 FROM s o WHERE o.contest_id = s.contest_id AND o.won)"""))
def opponents_of_winners(spark, d):
    """Sides of all contests in which a known team won."""
    sides = joins.team_contests(star.contests(spark, d)).select("contest_id", "team_id", "side", "won")
    return profiles.opponents(sides, sides.filter("won")).drop("won")


@query(sql("contests", """SELECT CAST(7 AS INTEGER) AS team_a, CAST(8 AS INTEGER) AS team_b, count(*) AS games,
    CAST(sum(CASE WHEN side0_won = (team0 = 7) THEN 1 ELSE 0 END) AS BIGINT) AS a_wins,
    CAST(count(*) - sum(CASE WHEN side0_won = (team0 = 7) THEN 1 ELSE 0 END) AS BIGINT) AS b_wins
    FROM contests WHERE side0_won IS NOT NULL AND ((team0 = 7 AND team1 = 8) OR (team0 = 8 AND team1 = 7)) HAVING count(*) > 0"""))
def head_to_head_pair(spark, d):
    return profiles.head_to_head(star.contests(spark, d), 7, 8)


# --- reports ------------------------------------------------------------------------------

@query(sql("contests", f"""SELECT strftime(to_timestamp(min(start_time)), '%Y-%m-%d') AS earliest,
    strftime(to_timestamp(max(start_time)), '%Y-%m-%d') AS latest, count(*) AS total,
    count_if(start_time >= {HORIZON}) AS within_horizon FROM contests WHERE league_id > 0"""))
def coverage(spark, d):
    return reports.coverage(star.contests(spark, d), AS_OF)


@query(sql("contests line_steps line_seats line_items", f"""SELECT 'contests (league)' AS table_name, count_if(league_id > 0) AS row_count FROM contests
    UNION ALL SELECT 'contests (both teams)', count_if(league_id > 0 AND {_TEAMS}) FROM contests
    UNION ALL SELECT 'contests (horizon)', count_if(league_id > 0 AND start_time >= {HORIZON}) FROM contests
    UNION ALL SELECT 'sides', count_if(team0 <> 0) + count_if(team1 <> 0) FROM contests
    UNION ALL SELECT 'steps', count(*) FROM line_steps UNION ALL SELECT 'players', count(*) FROM line_seats
    UNION ALL SELECT 'items', count(*) FROM line_items"""))
def row_counts(spark, d):
    t = line_tables(spark, d)
    return reports.row_counts(t.contests, joins.team_contests(t.contests), t.steps, t.players, t.items, AS_OF)


_TABLES = ["customer", "documents", "events", "lineitem", "orders", "part", "supplier"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES))
def table_row_counts(spark, d):
    return table_counts({t: load(spark, d, t) for t in _TABLES})


@query(sql("comp seq_steps", f"""WITH {DECISIONS.format(steps='seq_steps', season='')}
    SELECT count(*) AS n_rows, count(DISTINCT contest_id) AS n_contests, count(DISTINCT item_id) AS n_items,
    count_if(contest_id IS NULL) AS nulls_contest_id, count_if(item_id IS NULL) AS nulls_item_id,
    count_if(acting_team IS NULL) AS nulls_acting_team, count(*) > 100 AND count(DISTINCT contest_id) > 10 AS usable FROM dec"""))
def quality_report(spark, d):
    t = seq_tables(spark, d)
    return reports.quality_report(dec.decisions(t.steps, t.contests).select("contest_id", "item_id", "acting_team"))


@query("SELECT event_type AS stage, CASE WHEN value > 50 THEN 'failure' ELSE 'success' END AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def outcome_counts(spark, d):
    e = load(spark, d, "events").select(
        F.col("event_type").alias("stage"), F.when(F.col("value") > 50, "failure").otherwise("success").alias("kind"))
    return reports.outcome_counts(e)


@query(sql("comp seq_steps", f"WITH {DECISIONS.format(steps='seq_steps', season='')} SELECT contest_id, slot, item_id FROM dec"))
def training_order(spark, d):
    t = seq_tables(spark, d)
    return dec.ordered_for_training(dec.decisions(t.steps, t.contests)).select("contest_id", "slot", "item_id")


@query(sql("line_team_item line_synergy line_counter line_actor_team line_actor_item", " UNION ALL ".join(
    f"SELECT '{v}' AS view, count(*) AS row_count FROM {p}" for v, p in [
        ("team_item_profile", "line_team_item"), ("pair_synergy", "line_synergy"), ("pair_counter", "line_counter"),
        ("actor_team_history", "line_actor_team"), ("actor_item_profile", "line_actor_item")])))
def refresh_report(spark, d):
    return refresh.refresh_report(line_tables(spark, d), AS_OF)


@query(sql("line_actor_item_all contests", f"""SELECT DATE '{AS_OF}' AS snapshot_date, account_id, item_id, games, wins, shrunk_wr,
    CAST((SELECT max(season_id) FROM contests) - 2 AS INTEGER) AS season_min, (SELECT max(season_id) FROM contests) AS season_max
    FROM line_actor_item_all WHERE games >= 1"""))
def profile_snapshot(spark, d):
    t = line_tables(spark, d)
    return refresh.snapshot(profiles.actor_item_profile(t, None), t.contests, AS_OF)


# --- upserts: decided orders are stored, unfinished and open ones arrive ---------------------

_VERSION = """SELECT contest_id, start_time, {won} AS side0_won, season_id, {score} AS score0, {parsed} AS is_parsed FROM contests WHERE {where}"""
_STORED = dict(won="side0_won", score="CAST(NULL AS INTEGER)", parsed="season_id % 2 = 0", where="side0_won IS NOT NULL")
_INCOMING = dict(won="CAST(NULL AS BOOLEAN)", score="lobby", parsed="lobby < 3", where="side0_won IS NULL OR NOT side0_won")


def _versions(spark, d):
    c = star.contests(spark, d)
    stored = c.filter("side0_won is not null").select(
        "contest_id", "start_time", "side0_won", "season_id", F.lit(None).cast("int").alias("score0"),
        (F.col("season_id") % 2 == 0).alias("is_parsed"))
    incoming = c.filter("side0_won is null or not side0_won").select(
        "contest_id", "start_time", F.lit(None).cast("boolean").alias("side0_won"),
        (F.col("season_id") + 100).alias("season_id"), F.col("lobby").alias("score0"), (F.col("lobby") < 3).alias("is_parsed"))
    return stored, incoming


_IN_SQL = _VERSION.format(**_INCOMING).replace("season_id,", "season_id + 100 AS season_id,", 1)


@query(sql("contests", f"""WITH o AS ({_VERSION.format(**_STORED)}), n AS ({_IN_SQL})
    SELECT coalesce(o.contest_id, n.contest_id) AS contest_id, coalesce(o.start_time, n.start_time) AS start_time,
      CASE WHEN o.contest_id IS NULL THEN n.side0_won WHEN n.contest_id IS NOT NULL AND (NOT o.is_parsed OR n.is_parsed)
        THEN coalesce(n.side0_won, o.side0_won) ELSE o.side0_won END AS side0_won,
      CASE WHEN o.contest_id IS NULL THEN n.season_id ELSE o.season_id END AS season_id,
      CASE WHEN o.contest_id IS NULL THEN n.score0 WHEN n.contest_id IS NOT NULL AND (NOT o.is_parsed OR n.is_parsed)
        THEN coalesce(n.score0, o.score0) ELSE o.score0 END AS score0,
      CASE WHEN o.contest_id IS NULL THEN n.is_parsed WHEN n.contest_id IS NOT NULL AND (NOT o.is_parsed OR n.is_parsed)
        THEN o.is_parsed OR n.is_parsed ELSE o.is_parsed END AS is_parsed
    FROM o FULL JOIN n ON o.contest_id = n.contest_id AND o.start_time = n.start_time"""))
def upsert_contests(spark, d):
    return upserts.upsert_contests(*_versions(spark, d))


@query(sql("contests", f"""WITH o AS ({_VERSION.format(**_STORED)}), n AS ({_IN_SQL})
    SELECT * FROM o UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.contest_id = n.contest_id)"""))
def upsert_first_wins(spark, d):
    stored, incoming = _versions(spark, d)
    return upserts.first_wins(stored, incoming.unionByName(incoming), ["contest_id"], ["season_id"])


@query(sql("contests", f"""WITH o AS ({_VERSION.format(**_STORED)}), n AS ({_IN_SQL})
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE o.contest_id = n.contest_id)"""))
def upsert_last_wins(spark, d):
    stored, incoming = _versions(spark, d)
    older = incoming.withColumn("season_id", F.col("season_id") - 1000)
    return upserts.last_wins(stored, incoming.unionByName(older), ["contest_id"], ["season_id"])


@query("""WITH o AS (SELECT l_orderkey AS k, l_partkey AS p, l_quantity AS q FROM lineitem WHERE l_returnflag <> 'N'),
    n AS (SELECT l_orderkey AS k, l_partkey AS p, l_quantity AS q FROM lineitem WHERE l_returnflag = 'N')
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.k = o.k)""")
def upsert_replace_by_key(spark, d):
    l = load(spark, d, "lineitem")
    rows = lambda cond: l.filter(cond).select(
        F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p"), F.col("l_quantity").alias("q"))
    return upserts.replace_by_key(rows("l_returnflag <> 'N'"), rows("l_returnflag = 'N'"), ["k"])


@query("""SELECT coalesce(c_custkey, s_suppkey) AS id, c_name AS name, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END
      AS balance, coalesce(c_nationkey < 5, false) OR s_suppkey IS NOT NULL AS is_pro
    FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""")
def upsert_partial(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                          F.col("c_acctbal").alias("balance"), (F.col("c_nationkey") < 5).alias("is_pro"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"),
                                          F.lit(True).alias("is_pro"))
    return upserts.partial_upsert(c, s, ["id"], ["balance"], ["is_pro"])


@query(sql("contests", """SELECT contest_id, start_time - 60 AS first_time, start_time AS last_time FROM contests WHERE side0_won"""))
def moved_contests(spark, d):
    c = star.contests(spark, d)
    moved = c.filter("side0_won").withColumn("start_time", F.col("start_time") - 60)
    return upserts.moved_contests(c, moved)


@query(sql("line_players", "SELECT contest_id, player_slot FROM line_players WHERE lobby <> 3"))
def parsed_children(spark, d):
    from draftlake.operators import decode
    flagged = docs(spark, d, "match_id", "start_time", "players").withColumn("is_parsed", filters.is_parsed("players"))
    return decode.decode_players(upserts.parsed_only(flagged)).select("contest_id", "player_slot")


# --- quarters -----------------------------------------------------------------------------

_Q = "year(to_timestamp(start_time)) || '_q' || quarter(to_timestamp(start_time))"


@query(sql("contests", f"""WITH p AS (SELECT unnest(generate_series(DATE '1998-01-01', DATE '2000-10-01', INTERVAL 3 MONTH)) AS q),
    c AS (SELECT count(*) AS rows FROM contests WHERE {_Q} NOT IN (SELECT year(q) || '_q' || quarter(q) FROM p))
    SELECT 'contests' AS table_name, rows, CASE WHEN rows > 1000 THEN 'CRITICAL' ELSE 'WARNING' END AS level FROM c WHERE rows > 100
    UNION ALL SELECT 'ALL_OK', 0, 'OK' FROM c WHERE rows <= 100"""))
def partition_health(spark, d):
    q = maintenance.planned_quarters(spark, "2000-05-01", 2, since="1998-01-01")
    return maintenance.partition_health({"contests": star.contests(spark, d)}, q)


@query(sql("contests", """SELECT 'ALL_OK' AS table_name, CAST(0 AS BIGINT) AS rows, 'OK' AS level
    WHERE (SELECT count(*) FROM contests WHERE start_time < epoch(DATE '1995-01-01') OR start_time >= epoch(DATE '2002-04-01')) <= 100"""))
def partition_health_fine(spark, d):
    q = maintenance.planned_quarters(spark, AS_OF, 2, since="1995-01-01")
    return maintenance.partition_health({"contests": star.contests(spark, d)}, q)


@query(sql("contests", f"""SELECT {_Q} AS quarter, count(*) AS rows FROM contests WHERE year(to_timestamp(start_time)) < 1999 GROUP BY 1"""))
def expired_quarters(spark, d):
    return maintenance.expired_quarters(star.contests(spark, d), AS_OF)


@query(sql("contests", "SELECT contest_id, start_time FROM contests WHERE year(to_timestamp(start_time)) >= 1999"))
def retained_contests(spark, d):
    return maintenance.retain(star.contests(spark, d), AS_OF).select("contest_id", "start_time")


@query(sql("contests", f"""WITH q AS (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2002-01-01', INTERVAL 3 MONTH)) AS d)
    SELECT year(d) || '_q' || quarter(d) AS quarter, CAST(epoch(d) AS BIGINT) AS start_at,
    CAST(epoch(d + INTERVAL 3 MONTH) AS BIGINT) AS end_at, (SELECT count(*) FROM contests WHERE {_Q} = year(d) || '_q' || quarter(d))
    AS n FROM q"""))
def planned_quarters(spark, d):
    q = maintenance.planned_quarters(spark, AS_OF, 2, since="2001-01-01")
    n = maintenance.quarter_counts(star.contests(spark, d)).withColumnRenamed("rows", "n")
    return q.join(n, "quarter", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


# --- quarantine ---------------------------------------------------------------------------

_REASON = """CASE WHEN contest_id = 0 THEN 'invalid_contest_id' WHEN side0_won IS NULL THEN
      CASE lobby WHEN 1 THEN 'invalid_pick_side' WHEN 2 THEN 'invalid_player_slot' WHEN 4 THEN 'negative_duration'
      WHEN 5 THEN 'start_time_missing' END END"""
_HELD = "contest_id IN (SELECT l_orderkey FROM lineitem)"


@query(sql("contests line_steps", f"""WITH n AS (SELECT contest_id, count(*) AS n FROM line_steps GROUP BY 1),
    r AS (SELECT coalesce({_REASON}, CASE WHEN n < 16 THEN 'draft_length' END, 'ok') AS reason FROM contests JOIN n USING (contest_id))
    SELECT CASE WHEN reason = 'ok' THEN 'ok' WHEN reason LIKE 'draft%' THEN 'draft_schema' ELSE 'validate' END AS kind, reason,
    count(*) AS n FROM r GROUP BY ALL"""))
def quarantine_split(spark, d):
    checked = qt.with_fault(docs(spark, d, "match_id", "start_time", "duration", "game_mode", "players", "picks_bans",
                                 faulty=True))
    ok = F.lit("ok")
    return checked.groupBy(F.coalesce("kind", ok).alias("kind"), F.coalesce("reason", ok).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


def _quarantine(spark, d):
    """Every order line as a quarantine entry of its order, in the order of the lines' keys."""
    l = load(spark, d, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)"))
    e = l.groupBy(key.alias("raw"), F.col("l_orderkey").alias("contest_id"), "l_linenumber", "l_shipdate").agg(
        F.count(F.lit(1)).alias("copies"))
    from draftlake.functions.scalars import epoch_of
    return e.select(F.md5("raw").alias("quarantine_id"), "contest_id", F.lit("parse").alias("kind"),
                    F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("reason"), "raw",
                    epoch_of("l_shipdate").alias("received_at"), F.lit(3).alias("retries"))


_QUAR = """q AS (SELECT md5(raw) AS quarantine_id, contest_id, 'parse' AS kind, 'line ' || n AS reason, raw, received_at, 3 AS retries FROM (
    SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_extendedprice AS DECIMAL(18,2)) AS raw,
      l_orderkey AS contest_id, l_linenumber AS n, CAST(epoch(l_shipdate) AS BIGINT) AS received_at FROM lineitem)),
    newest AS (SELECT * FROM q ORDER BY received_at DESC, quarantine_id LIMIT 500),
    guard AS (SELECT o_orderkey AS contest_id, 1000000 AS replayed_at FROM orders WHERE o_orderpriority = '1-URGENT'),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contest_id ORDER BY received_at DESC, quarantine_id) AS r
      FROM newest WHERE contest_id NOT IN (SELECT contest_id FROM guard)) WHERE r = 1)"""


def _guard(spark, d):
    return load(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("contest_id"), F.lit(1_000_000).alias("replayed_at"))


@query(f"WITH {_QUAR} SELECT quarantine_id, contest_id, kind, reason, retries, CAST(strlen(raw) AS INTEGER) AS payload_bytes, received_at FROM newest")
def quarantine_list(spark, d):
    return qt.list_quarantine(_quarantine(spark, d), 500)


@query(f"WITH {_QUAR} SELECT quarantine_id, contest_id, kind, reason, raw, received_at, 0 AS retries FROM once")
def quarantine_replay(spark, d):
    replayed, _, _ = qt.replay_quarantine(_quarantine(spark, d), _guard(spark, d), 1_000_100, 500)
    return replayed


@query(f"WITH {_QUAR} SELECT quarantine_id, contest_id FROM q WHERE quarantine_id NOT IN (SELECT quarantine_id FROM once)")
def quarantine_remaining(spark, d):
    _, remaining, _ = qt.replay_quarantine(_quarantine(spark, d), _guard(spark, d), 1_000_100, 500)
    return remaining.select("quarantine_id", "contest_id")


@query(f"WITH {_QUAR} SELECT (SELECT count(*) FROM once) AS replayed, (SELECT count(*) FROM newest) - (SELECT count(*) FROM once) AS skipped")
def quarantine_dry_run(spark, d):
    return qt.replay_counts(_quarantine(spark, d), _guard(spark, d), 1_000_100, 500)


@query(f"WITH {_QUAR} SELECT quarantine_id FROM q WHERE quarantine_id NOT IN (SELECT quarantine_id FROM newest)")
def quarantine_purge(spark, d):
    return qt.purge_quarantine(_quarantine(spark, d), 500).select("quarantine_id")
