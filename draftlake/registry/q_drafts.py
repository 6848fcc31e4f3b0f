"""Draft sequences, running windows, decisions and candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from draftlake.operators import drafts, windows
from draftlake.plans import decisions as dec
from draftlake.registry.core import query
from draftlake.registry.inputs import line_tables, seq_tables
from draftlake.registry.sqlparts import sql
from draftlake.sources import star

# Eras with their length, the pattern of a whole draft and of its beginning, stated here for the SQL on its own.
_ERAS = [
    ("7_33_plus", 24, "^B{0,7}P{2}B{0,3}P{6}B{0,4}P{2}$", "^B{0,7}(P{0,1}|P{2}B{0,3}(P{0,5}|P{6}B{0,4}P{0,2}))$"),
    ("7_30_to_7_32", 24, "^B{0,4}P{4}B{0,6}P{4}B{0,4}P{2}$", "^B{0,4}(P{0,3}|P{4}B{0,6}(P{0,3}|P{4}B{0,4}P{0,2}))$"),
    ("pre_7_30", 20, "^B{0,4}P{6}B{0,6}P{4}$", "^B{0,4}(P{0,5}|P{6}B{0,6}P{0,4})$"),
]
_CODES = """codes AS (SELECT contest_id, count(*) AS n_steps, count_if(is_pick) AS n_picks,
    string_agg(CASE WHEN is_pick THEN 'P' ELSE 'B' END, '' ORDER BY slot) AS code,
    sha256(string_agg(side || ':' || CASE WHEN is_pick THEN 'pick' ELSE 'ban' END || '|', '' ORDER BY slot)) AS digest
    FROM {steps} GROUP BY 1)"""
_FAULT = "CASE WHEN n_steps NOT BETWEEN 16 AND 24 THEN 'length' WHEN n_picks <> 10 THEN 'pick_count' WHEN NOT (" + \
    " OR ".join(f"regexp_matches(code, '{e[2]}')" for e in _ERAS) + ") THEN 'pattern' END"
_ERA = "coalesce(list_min([" + ", ".join(
    f"CASE WHEN regexp_matches(code, '{e[3]}') AND {e[1]} - n_steps <= n_steps "
    f"THEN {{'gap': {e[1]} - n_steps, 'rank': {i}, 'name': '{e[0]}'}} END"
    for i, e in enumerate(_ERAS)) + "]).name, 'unknown')"


def _validated(steps: str) -> str:
    return sql(f"{steps} contests", f"""WITH {_CODES.format(steps=steps)}
        SELECT contest_id, n_steps, n_picks, code, {_FAULT} AS fault, {_ERA} AS era, digest FROM codes""")


@query(_validated("seq_steps"))
def draft_validation(spark, d):
    return drafts.validate_drafts(star.sequence_steps(spark, d))


@query(_validated("line_steps"))
def draft_validation_short(spark, d):
    return drafts.validate_drafts(star.line_steps(spark, d))


@query(sql("seq_steps contests", f"""WITH {_CODES.format(steps='seq_steps')},
    v AS (SELECT contest_id, {_FAULT} AS fault, {_ERA} AS era, digest FROM codes)
    SELECT CAST(to_timestamp(start_time) AS DATE) AS day, era, digest, count(*) AS n_contests,
    count(fault) AS n_invalid FROM v JOIN contests USING (contest_id) GROUP BY 1, 2, 3"""))
def format_canary(spark, d):
    return drafts.format_canary(star.sequence_steps(spark, d), star.contests(spark, d))


_SAMPLE = """sample AS (SELECT contest_id FROM contests WHERE season_id = (SELECT max(season_id) FROM contests)
    )"""


@query(sql("contests line_steps", f"""WITH {_SAMPLE}, n AS (SELECT slot, side, count(*) AS c FROM line_steps
      SEMI JOIN sample USING (contest_id) GROUP BY 1, 2),
    m AS (SELECT slot, side AS side_mode FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY c DESC, side) rn
      FROM n) WHERE rn = 1)
    SELECT slot, side_mode, bool_and(is_pick) AS all_picks, count(DISTINCT is_pick) = 1 AS consistent
    FROM line_steps SEMI JOIN sample USING (contest_id) JOIN m USING (slot) GROUP BY 1, 2"""))
def slot_template(spark, d):
    t = line_tables(spark, d)
    return drafts.slot_template(t.steps, drafts.newest_season_sample(t.contests))


_TEMPLATE = f"""WITH {_SAMPLE}, s AS (SELECT * FROM {{steps}} SEMI JOIN sample USING (contest_id)),
    n AS (SELECT slot, side, count(*) AS c FROM s GROUP BY 1, 2),
    m AS (SELECT slot, side AS side_mode FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY c DESC, side) rn
      FROM n) WHERE rn = 1),
    t AS (SELECT slot, side_mode, bool_and(is_pick) AS all_picks, count(DISTINCT is_pick) AS kinds
      FROM s JOIN m USING (slot) GROUP BY 1, 2)"""
_CHECKS = """a AS (SELECT count(*) AS n, min(slot) AS lo, max(slot) AS hi, bool_and(kinds = 1) AS ok,
      bool_and(side_mode IN (0, 1)) AS sides, count_if(all_picks) AS p, count_if(NOT all_picks) AS b FROM t)
    SELECT 'SLOT_COUNT' AS check_name, CASE WHEN n = 24 THEN 'PASS' ELSE 'FAIL' END AS status, 'slots: ' || n AS detail FROM a
    UNION ALL SELECT 'SLOT_CONTIGUITY', CASE WHEN lo = 0 AND hi = 23 AND n = 24 THEN 'PASS' ELSE 'FAIL' END,
      'slot range: ' || lo || '..' || hi FROM a
    UNION ALL SELECT 'PICK_CONSISTENCY', CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END, 'every slot has one action' FROM a
    UNION ALL SELECT 'TEAM_VALIDITY', CASE WHEN sides THEN 'PASS' ELSE 'FAIL' END, 'every common side is 0 or 1' FROM a
    UNION ALL SELECT 'PICK_BAN_TOTALS', CASE WHEN p = 10 AND b = 14 THEN 'PASS' ELSE 'WARN' END,
      'picks: ' || p || ', bans: ' || b FROM a
    UNION ALL SELECT 'DISAGREEMENT', 'ANOMALY', 'mixed actions in slot ' || slot FROM t WHERE kinds > 1
    UNION ALL SELECT 'TEAM_ANOMALY', 'ANOMALY', 'slot ' || slot || ' has sides ' || string_agg(side, ',' ORDER BY side)
      FROM (SELECT DISTINCT slot, side FROM s WHERE side NOT IN (0, 1)) GROUP BY slot"""


@query(sql("contests seq_steps", f"{_TEMPLATE.format(steps='seq_steps')}, {_CHECKS}"))
def verify_template(spark, d):
    t = seq_tables(spark, d)
    return drafts.verify_template(t.steps, drafts.newest_season_sample(t.contests))


@query(sql("contests line_steps", f"{_TEMPLATE.format(steps='line_steps')}, {_CHECKS}"))
def verify_template_lines(spark, d):
    t = line_tables(spark, d)
    return drafts.verify_template(t.steps, drafts.newest_season_sample(t.contests))


@query(sql("contests seq_steps", f"""{_TEMPLATE.format(steps='seq_steps')} SELECT slot,
    CASE WHEN all_picks THEN 'PICK' ELSE 'BAN' END AS action,
    CASE WHEN side_mode = 0 THEN 'side 0' ELSE 'side 1' END AS side_name, side_mode FROM t"""))
def template_pattern(spark, d):
    t = seq_tables(spark, d)
    return drafts.template_pattern(drafts.slot_template(t.steps, drafts.newest_season_sample(t.contests)))


@query(sql("seq_steps template", """SELECT t.slot, t.phase, NOT t.is_pick AS is_ban, t.side, count(s.contest_id) AS n_steps
    FROM template t LEFT JOIN seq_steps s ON s.slot = t.slot GROUP BY ALL"""))
def standard_template(spark, d):
    used = star.sequence_steps(spark, d).groupBy("slot").agg(F.count(F.lit(1)).alias("n_steps"))
    return drafts.standard_template(spark).join(used, "slot", "left").withColumn(
        "n_steps", F.coalesce("n_steps", F.lit(0).cast("bigint")))


_PHASES = """p AS (SELECT *, CAST(sum(sw) OVER (PARTITION BY contest_id ORDER BY slot ROWS UNBOUNDED PRECEDING) AS INTEGER)
      AS phase, first_value(is_pick) OVER (PARTITION BY contest_id ORDER BY slot) AS opens FROM (
      SELECT *, CASE WHEN is_pick <> lag(is_pick) OVER (PARTITION BY contest_id ORDER BY slot) THEN 1 ELSE 0 END AS sw
      FROM {steps}))"""


@query(sql("seq_steps", f"""WITH {_PHASES.format(steps='seq_steps')}
    SELECT contest_id, slot, is_pick, item_id, side, phase FROM p"""))
def assign_phases(spark, d):
    return windows.assign_phases(star.sequence_steps(spark, d))


@query(sql("line_steps", f"""WITH {_PHASES.format(steps='line_steps')},
    q AS (SELECT *, phase + CAST(opens AS INTEGER) AS ph FROM p)
    SELECT contest_id, slot, is_pick, item_id, side, ph AS phase,
    CASE WHEN is_pick THEN 'pick_' ELSE 'ban_' END || (ph // 2 + 1) AS phase_name,
    CASE WHEN is_pick THEN CASE WHEN ph % 2 = 0 THEN 1 ELSE 0 END ELSE CASE WHEN ph % 2 = 0 THEN 0 ELSE 1 END END AS phase_side
    FROM q"""))
def derive_phases(spark, d):
    return windows.derive_phases(star.line_steps(spark, d))


@query(sql("seq_steps", """SELECT *, CAST(row_number() OVER (PARTITION BY contest_id ORDER BY slot) - 1 AS INTEGER)
    AS local_slot FROM seq_steps"""))
def local_slots(spark, d):
    return windows.local_slots(star.sequence_steps(spark, d))


def _before(cond: str) -> str:
    return (f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) OVER (PARTITION BY contest_id ORDER BY slot "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER)")


_CTX = f"""ctx AS (SELECT *, CASE WHEN side = 0 THEN p0 ELSE p1 END AS team_picks_before,
      CASE WHEN side = 0 THEN p1 ELSE p0 END AS enemy_picks_before,
      CASE WHEN side = 0 THEN b0 ELSE b1 END AS team_bans_before, CASE WHEN side = 0 THEN b1 ELSE b0 END AS enemy_bans_before,
      p0 + p1 AS picks_before, b0 + b1 AS bans_before FROM (SELECT *, {_before('is_pick AND side = 0')} AS p0,
      {_before('is_pick AND side = 1')} AS p1, {_before('NOT is_pick AND side = 0')} AS b0,
      {_before('NOT is_pick AND side = 1')} AS b1 FROM {{steps}}))"""


@query(sql("seq_steps", f"WITH {_CTX.format(steps='seq_steps')} SELECT * EXCLUDE (p0, p1, b0, b1) FROM ctx"))
def draft_context(spark, d):
    return windows.draft_context(star.sequence_steps(spark, d))


def _list_before(cond: str) -> str:
    return (f"coalesce(string_agg(CASE WHEN {cond} THEN CAST(item_id AS VARCHAR) END, ',') OVER (PARTITION BY contest_id "
            "ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')")


def _joined(c):
    return F.array_join(F.transform(c, lambda i: i.cast("string")), ",")


@query(sql("seq_steps", f"""SELECT contest_id, slot, is_pick, item_id, side, {_list_before('true')} AS drafted,
    CASE WHEN side = 0 THEN {_list_before('is_pick AND side = 0')} ELSE {_list_before('is_pick AND side = 1')} END AS allies,
    CASE WHEN side = 1 THEN {_list_before('is_pick AND side = 0')} ELSE {_list_before('is_pick AND side = 1')} END AS enemies
    FROM seq_steps"""))
def draft_state(spark, d):
    s = windows.draft_state(star.sequence_steps(spark, d))
    return s.select("contest_id", "slot", "is_pick", "item_id", "side", _joined("drafted").alias("drafted"),
                    _joined("allies").alias("allies"), _joined("enemies").alias("enemies"))


DECISIONS = """dec AS (SELECT contest_id, start_time, season_id, slot, is_pick, item_id, side,
    CASE WHEN side = 0 THEN team0 ELSE team1 END AS acting_team, CASE WHEN side = 0 THEN team1 ELSE team0 END AS opp_team,
    CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS acting_won,
    CAST(CASE WHEN side = 0 THEN side0_won ELSE NOT side0_won END AS INTEGER) AS value_label
    FROM {steps} JOIN comp USING (contest_id) WHERE side0_won IS NOT NULL{season})"""


@query(sql("comp seq_steps", f"WITH {DECISIONS.format(steps='seq_steps', season=' AND season_id = 1998')} SELECT * FROM dec"))
def decisions(spark, d):
    t = seq_tables(spark, d)
    return dec.decisions(t.steps, t.contests, 1998)


@query(sql("comp line_steps", f"WITH {DECISIONS.format(steps='line_steps', season='')} SELECT * FROM dec"))
def decisions_all_seasons(spark, d):
    t = line_tables(spark, d)
    return dec.decisions(t.steps, t.contests)


# The seeded order of the negatives, stated in SQL.
SAMPLE_KEY = "(k1 * k1 + i) % 2147483647"
CANDIDATES = """pk AS (SELECT * FROM dec WHERE is_pick),
    free AS (SELECT pk.contest_id, pk.slot, it.item_id AS i FROM pk, {items} it WHERE NOT EXISTS (
      SELECT 1 FROM dec o WHERE o.contest_id = pk.contest_id AND o.slot <= pk.slot AND o.item_id = it.item_id)),
    keyed AS (SELECT *, (contest_id % 2147483647 * 48271 + slot * 16807 + i * 69621 + 42) % 2147483647 AS k1 FROM free),
    neg AS (SELECT contest_id, slot, i FROM (SELECT *, row_number() OVER (PARTITION BY contest_id, slot
      ORDER BY """ + SAMPLE_KEY + """, i) AS rn FROM keyed) WHERE rn <= 30),
    cand AS (SELECT contest_id, slot, item_id, 1.0::DOUBLE AS label FROM pk
      UNION ALL SELECT contest_id, slot, i AS item_id, 0.0::DOUBLE AS label FROM neg)"""


@query(sql("comp seq_steps seq_items", f"""WITH {DECISIONS.format(steps='seq_steps', season='')},
    {CANDIDATES.format(items='seq_items')} SELECT item_id, slot, count(*) AS n,
    CAST(sum(label) AS BIGINT) AS n_chosen, CAST(sum(contest_id) AS BIGINT) AS contest_sum FROM cand GROUP BY 1, 2"""))
def candidates(spark, d):
    """All candidates of all picks, reported per item and slot."""
    t = seq_tables(spark, d)
    rows = dec.candidates(dec.decision_states(dec.decisions(t.steps, t.contests)), t.items)
    return rows.groupBy("item_id", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("n_chosen"),
        F.sum("contest_id").alias("contest_sum"))


@query(sql("seq_steps seq_items", """SELECT s.contest_id, s.slot, (SELECT count(*) FROM seq_items WHERE item_id > 0)
      - count(o.item_id) AS n_legal FROM seq_steps s LEFT JOIN seq_steps o ON o.contest_id = s.contest_id AND o.slot < s.slot
    AND EXISTS (SELECT 1 FROM seq_items i WHERE i.item_id = o.item_id) GROUP BY 1, 2"""))
def legal_pool(spark, d):
    t = seq_tables(spark, d)
    states = windows.draft_state(t.steps).withColumn("catalogue", dec.catalogue_array(t.items).scalar())
    return states.select("contest_id", "slot", F.size(dec.legal_pool(F.col("catalogue"), "drafted"))
                         .cast("bigint").alias("n_legal"))


_TRAIN_K = "(contest_id % 2147483647 * 48271 + 42) % 2147483647"
_TRAIN = f"floor((({_TRAIN_K}) * ({_TRAIN_K}) % 2147483647) * 100 / 2147483647) < 80"


@query(sql("contests", f"SELECT contest_id, {_TRAIN} AS is_training FROM contests"))
def train_split(spark, d):
    return star.contests(spark, d).select("contest_id", dec.is_training().alias("is_training"))


@query(sql("comp seq_steps", f"""WITH {DECISIONS.format(steps='seq_steps', season='')}
    SELECT * FROM (UNPIVOT (SELECT count_if(slot IS NULL) AS slot, count_if(item_id IS NULL) AS item_id,
      count_if(acting_team IS NULL) AS acting_team, count_if(value_label IS NULL) AS value_label FROM dec)
    ON slot, item_id, acting_team, value_label INTO NAME feature VALUE bad_values)"""))
def finite_check(spark, d):
    t = seq_tables(spark, d)
    return dec.check_finite(dec.decisions(t.steps, t.contests), ["slot", "item_id", "acting_team", "value_label"])
