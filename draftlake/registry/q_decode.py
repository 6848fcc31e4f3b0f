"""Documents, envelopes and constants decoded back into tables, checked against the relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from draftlake.functions.scalars import (
    flex_epoch, guarded_ratio, json_or_null, poly_array, poly_first, poly_flag, poly_text, quarter_of,
)
from draftlake.operators import decode, dimensions, filters
from draftlake.plans import decisions
from draftlake.registry.core import query
from draftlake.registry.sqlparts import sql
from draftlake.sources import envelopes, star
from draftlake.sources.documents import parse_documents
from draftlake.sources.tables import load


def docs(spark, d, *fields, faulty=False):
    """Parsed documents, restricted to the named top-level fields when there are any."""
    return parse_documents(star.contest_documents(spark, d, faulty), fields=[*fields] if fields else None)


_HELD = "WHERE contest_id IN (SELECT l_orderkey FROM lineitem)"


@query(sql("contests", f"""SELECT contest_id, start_time, CAST(600 + contest_id % 3000 AS INTEGER) AS duration, side0_won, lobby, 2 AS game_mode,
    season_id, league_id, team0, team1, CAST(contest_id % 50 AS INTEGER) AS score0, CAST(NULL AS INTEGER) AS score1,
    CAST(NULL AS VARCHAR) AS replay_url, CAST(NULL AS VARCHAR) AS pauses, lobby <> 3 AS is_parsed FROM contests {_HELD}"""))
def decode_contests(spark, d):
    return decode.decode_contests(docs(spark, d)).select(
        "contest_id", "start_time", "duration", "side0_won", "lobby", "game_mode", "season_id", "league_id", "team0",
        "team1", "score0", "score1", "replay_url", "pauses", "is_parsed")


@query(sql("contests", f"""SELECT contest_id, side0_won, 0 AS score1, CAST(0 AS BIGINT) AS captain0, 0 AS first_blood_time,
    '' AS replay_url, CAST(0 AS BIGINT) AS replay_salt FROM contests {_HELD}"""))
def decode_contests_zero_filled(spark, d):
    return decode.decode_contests(docs(spark, d), absent_as_zero=True).select(
        "contest_id", "side0_won", "score1", "captain0", "first_blood_time", "replay_url", "replay_salt")


@query(sql("line_players", """SELECT contest_id, player_slot, start_time, account_id, item_id, side, won, season_id,
    item_id % 10 AS kills, player_slot % 128 % 2 <> 0 AS firstblood_claimed, false AS is_roaming, CAST(NULL AS INTEGER) AS gold
    FROM line_players"""))
def decode_players(spark, d):
    return decode.decode_players(docs(spark, d, "match_id", "start_time", "players")).select(
        "contest_id", "player_slot", "start_time", "account_id", "item_id", "side", "won", "season_id", "kills",
        "firstblood_claimed", "is_roaming", "gold")


@query(sql("line_players", """SELECT contest_id, player_slot, CASE WHEN player_slot % 128 = 0 THEN
    '[{"time":5,"key":"potion"}]' END AS purchase_log, '{"n":' || item_id || '}' AS killed, CAST(NULL AS VARCHAR) AS damage
    FROM line_players WHERE lobby <> 3"""))
def decode_player_details(spark, d):
    return decode.decode_player_details(docs(spark, d, "match_id", "players")).select(
        "contest_id", "player_slot", "purchase_log", "killed", "damage")


@query(sql("line_steps", "SELECT contest_id, slot, is_pick, item_id, side FROM line_steps"))
def decode_steps(spark, d):
    return decode.decode_steps(docs(spark, d, "match_id", "picks_bans"))


@query(sql("line_steps", """SELECT contest_id, slot, is_pick, side AS active_side, CASE WHEN is_pick THEN item_id END AS item_id,
    CAST(NULL AS INTEGER) AS player_slot, CAST(NULL AS INTEGER) AS extra_time, slot * 3 AS total_time_taken FROM line_steps"""))
def decode_draft_timings(spark, d):
    return decode.decode_draft_timings(docs(spark, d, "match_id", "draft_timings"))


@query(sql("line_steps", """SELECT contest_id, slot * 60 AS time, 'building_kill' AS type, 0 AS slot, 0 AS player_slot,
    side AS team, CASE WHEN is_pick THEN 'k' ELSE '' END || item_id AS key, 0 AS value, '' AS unit FROM line_steps"""))
def decode_objectives(spark, d):
    return decode.decode_objectives(docs(spark, d, "match_id", "objectives")).drop("raw")


@query(sql("line_steps", """SELECT contest_id, slot * 10 AS time, 'chat' AS type, '' AS unit, 'line ' || item_id AS key,
    side AS player_slot FROM line_steps"""))
def decode_chat(spark, d):
    return decode.decode_chat(docs(spark, d, "match_id", "chat"))


@query(sql("line_steps", """SELECT contest_id, slot * 100 AS end_time, 0 AS last_death, item_id AS deaths,
    '[{"side":' || side || '}]' AS players FROM line_steps"""))
def decode_teamfights(spark, d):
    return decode.decode_teamfights(docs(spark, d, "match_id", "teamfights"))


@query(sql("line_steps contests", """SELECT contest_id, string_agg(CAST(item_id * 10 AS VARCHAR), ',' ORDER BY slot) AS gold_adv,
    '' AS xp_adv FROM line_steps JOIN contests USING (contest_id) WHERE side0_won IS NOT NULL GROUP BY 1"""))
def decode_advantages(spark, d):
    a = decode.decode_advantages(docs(spark, d, "match_id", "radiant_gold_adv", "radiant_xp_adv"))
    text = lambda c: F.array_join(F.transform(c, lambda i: i.cast("string")), ",")
    return a.select("contest_id", text("gold_adv").alias("gold_adv"), text("xp_adv").alias("xp_adv"))


@query(sql("contests", f"""SELECT contest_id, '{{"1":' || lobby || '}}' AS cosmetics FROM contests {_HELD} AND league_id > 0"""))
def decode_cosmetics(spark, d):
    return decode.decode_cosmetics(docs(spark, d, "match_id", "cosmetics"))


@query(sql("line_players", """SELECT contest_id, player_slot, CAST(m AS INTEGER) AS minute, start_time, item_id, account_id, season_id,
    CASE WHEN m <= player_slot % 128 THEN (m + 1) * item_id ELSE 0 END AS gold,
    CASE WHEN m <= player_slot % 128 THEN (m + 1) * item_id * 7 ELSE 0 END AS xp,
    least(CAST((m + 1) * item_id * 3000 AS INTEGER), 32767) AS lh, 0 AS dn
    FROM (SELECT *, unnest(range(0, player_slot % 128 + 2)) AS m FROM line_players WHERE lobby <> 3)""".replace(
        "THEN (m + 1) * item_id ELSE", "THEN CAST((m + 1) * item_id AS INTEGER) ELSE").replace(
        "THEN (m + 1) * item_id * 7 ELSE", "THEN CAST((m + 1) * item_id * 7 AS INTEGER) ELSE")))
def expand_timeseries(spark, d):
    return decode.expand_timeseries(decode.decode_players(docs(spark, d, "match_id", "start_time", "players")))


@query(sql("contests", f"""SELECT contest_id, lobby <> 3 AS is_parsed FROM contests {_HELD}"""))
def parsed_flags(spark, d):
    return docs(spark, d, "match_id", "players").select(F.col("match_id").alias("contest_id"), filters.is_parsed("players").alias("is_parsed"))


@query(sql("contests", f"""SELECT coalesce(CASE WHEN contest_id = 0 THEN 'invalid_contest_id' WHEN side0_won IS NULL THEN
      CASE lobby WHEN 1 THEN 'invalid_pick_side' WHEN 2 THEN 'invalid_player_slot' WHEN 4 THEN 'negative_duration'
      WHEN 5 THEN 'start_time_missing' END END, 'ok') AS reason, count(*) AS n FROM contests {_HELD} GROUP BY 1"""))
def contest_validation(spark, d):
    checked = docs(spark, d, "match_id", "start_time", "duration", "players", "picks_bans", faulty=True)
    return checked.groupBy(F.coalesce(filters.rejection_reason(), F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


# --- envelopes ----------------------------------------------------------------------------

@query(sql("contests", """SELECT contest_id, CASE WHEN side0_won IS NULL THEN 0 ELSE start_time END AS start_time
    FROM contests WHERE contest_id > 0"""))
def ref_envelope(spark, d):
    """Ids as text, as number, or in the older list form with junk beside them."""
    c = star.contests(spark, d)
    ident, t = F.col("contest_id").cast("string"), F.col("start_time").cast("string")
    body = (F.when(F.col("side0_won"), F.concat(F.lit('{"match_id":"'), ident, F.lit('","start_time":"'), t, F.lit('"}')))
            .when(~F.col("side0_won"), F.concat(F.lit('{"match_id":'), ident, F.lit(',"start_time":'), t, F.lit("}")))
            .otherwise(F.concat(F.lit('{"match_ids":['), ident, F.lit(',"invalid",0]}'))))
    return envelopes.parse_ref_envelope(
        c.select(F.concat(F.lit('{"rows":['), body, F.lit("]}")).alias("j")), "j")


@query("SELECT c_custkey AS team_id, c_name AS name, c_mktsegment AS tag, c_acctbal AS rating FROM customer WHERE c_custkey <> 0")
def entity_envelope(spark, d):
    rows = load(spark, d, "customer").select(F.to_json(F.struct(F.array(F.struct(
        F.col("c_custkey").alias("team_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("tag"),
        F.col("c_acctbal").alias("rating"))).alias("rows"))).alias("j"))
    return envelopes.parse_entity_envelope(rows, "j", "team_id bigint, name string, tag string, rating double", "team_id")


@query("SELECT s_suppkey AS account_id, s_name AS name, s_nationkey AS country FROM supplier")
def entity_array(spark, d):
    rows = load(spark, d, "supplier").select(F.to_json(F.array(F.struct(
        F.col("s_suppkey").alias("account_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("country")))).alias("j"))
    return envelopes.parse_entity_array(rows, "j", "account_id bigint, name string, country int")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_size AS size FROM part""")
def constants_map(spark, d):
    rows = load(spark, d, "part").select(F.to_json(F.create_map(
        F.col("p_partkey").cast("string"), F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")))).alias("j"))
    return envelopes.parse_constants(rows, "j", "struct<name:string, size:int>").select(
        "key", F.col("value.name").alias("name"), F.col("value.size").alias("size"))


@query("SELECT o_custkey AS custkey, o_orderkey AS contest_id, o_totalprice AS total FROM orders")
def unnest_arrays(spark, d):
    """Parallel arrays as rows; arrays of one order each, so no group is gathered."""
    o = load(spark, d, "orders").select("o_custkey", F.array("o_orderkey").alias("ids"), F.array("o_totalprice").alias("totals"),
                                        F.array("o_custkey").alias("custs"))
    return envelopes.unnest(o, custkey="custs", contest_id="ids", total="totals")


# --- dimensions ---------------------------------------------------------------------------

def _map_of(df, key, value):
    return df.select(F.to_json(F.create_map(key, value)).alias("j"))


@query("""SELECT CAST(p_partkey AS INTEGER) AS item_id, p_brand AS name, p_name || ' ' || p_partkey AS item_name,
    CASE p_size % 4 WHEN 0 THEN 'str' WHEN 1 THEN 'agi' WHEN 2 THEN 'int' END AS primary_attr, p_type AS attack_type, 2 AS legs
    FROM part WHERE p_partkey BETWEEN 1 AND 32767""")
def build_items(spark, d):
    p = load(spark, d, "part")
    attr = F.element_at(F.array(*[F.lit(a) for a in ("str", "agi", "int", " ")]), F.col("p_size") % 4 + 1)
    value = F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"),
                     F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("localized_name"),
                     attr.alias("primary_attr"), F.col("p_type").alias("attack_type"),
                     F.array("p_type").alias("roles"), F.lit(2).alias("legs"))
    return dimensions.build_items(_map_of(p, F.col("p_partkey").cast("string"), value), "j").drop("roles")


@query("SELECT p_name AS item_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_item_names(spark, d):
    return dimensions.duplicate_names(load(spark, d, "part").select(F.col("p_name").alias("item_name")))


@query("""SELECT o_orderkey AS item_id, CASE WHEN o_orderkey <= 0 THEN 'not positive' ELSE 'beyond two bytes' END AS reason FROM orders
    WHERE o_orderkey <= 0 OR o_orderkey > 32767""")
def unusable_items(spark, d):
    """Order keys taken for item ids: those that can be no candidate, with the reason."""
    return decisions.unusable_items(load(spark, d, "orders").select(F.col("o_orderkey").alias("item_id")))


@query(sql("seq_items", """SELECT item_id, CASE primary_attr WHEN 'str' THEN 1 WHEN 'agi' THEN 2 WHEN 'int' THEN 3 WHEN 'all' THEN 4
    ELSE 0 END AS attr, CAST(len(roles) AS INTEGER) AS roles_n FROM seq_items"""))
def item_meta(spark, d):
    return dimensions.item_meta(star.sequence_items(spark, d)).select("item_id", "attr", "roles_n")


_ROLE = "CASE p_size % 3 WHEN 0 THEN 'Carry' WHEN 1 THEN 'Support' ELSE 'Nuker' END"


@query(f"SELECT p_partkey AS item_id, {_ROLE} AS roles FROM part")
def known_roles(spark, d):
    from draftlake.functions.scalars import known_roles as known
    role = F.element_at(F.array(F.lit(" Carry"), F.lit("Support "), F.lit("Nuker")), F.col("p_size") % 3 + 1)
    return load(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"), F.array_join(known(F.array(role, F.col("p_type"))), ",").alias("roles"))


def _ability_docs(spark, d):
    p = load(spark, d, "part")
    key = F.when(F.col("p_size") == 1, "dota_base_ability").otherwise(F.concat(F.lit("a"), F.col("p_partkey").cast("string")))
    size = F.col("p_size").cast("string")
    mc = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"'), size, F.lit('"'))).when(
        F.col("p_size") % 3 == 1, F.concat(F.lit('["'), size, F.lit('","'), size, F.lit('"]'))).otherwise(size)
    behavior = F.when(F.col("p_size") % 3 == 0, F.lit('"Passive"')).when(
        F.col("p_size") % 3 == 1, F.lit('["A","B"]')).otherwise(F.lit("null"))
    value = F.struct(F.col("p_name").alias("dname"), F.col("p_brand").alias("desc"), F.parse_json(mc).alias("mc"),
                     F.parse_json(behavior).alias("behavior"))
    return _map_of(p, key, value)


_ABILITIES = """SELECT 'a' || p_partkey AS name, p_name AS localized, p_brand AS description,
    CASE p_size % 3 WHEN 0 THEN '' || p_size WHEN 1 THEN p_size || '/' || p_size ELSE '' END AS mana_cost, '' AS cooldown,
    CASE p_size % 3 WHEN 0 THEN '["Passive"]' WHEN 1 THEN '["A","B"]' ELSE '[]' END AS behavior, '[]' AS attrib
    FROM part WHERE p_size <> 1"""


@query(_ABILITIES)
def build_abilities(spark, d):
    return dimensions.build_abilities(_ability_docs(spark, d), "j").drop("img", "target_team")


@query(f"""WITH a AS ({_ABILITIES}), i AS (SELECT 'a' || p_partkey AS name, CAST(p_partkey AS INTEGER) AS ability_id FROM part
    WHERE p_partkey > 0) SELECT coalesce(a.name, i.name) AS name, localized, ability_id FROM a FULL JOIN i ON a.name = i.name""")
def attach_ability_ids(spark, d):
    p = load(spark, d, "part")
    ids = _map_of(p, F.concat(F.lit(" "), F.col("p_partkey").cast("string")), F.concat(F.lit("a"), F.col("p_partkey").cast("string")))
    out = dimensions.attach_ability_ids(dimensions.build_abilities(_ability_docs(spark, d), "j"),
                                        dimensions.parse_id_map(ids, "j", 1))
    return out.select("name", "localized", "ability_id")


def _kit_docs(spark, d):
    p = load(spark, d, "part")
    size = F.col("p_size").cast("string")
    text = F.concat(
        F.lit('{"h'), F.col("p_partkey").cast("string"),
        F.lit('":{"abilities":["generic_hidden",["x'), size, F.lit('","y"],"z'), size,
        F.lit('",null],"talents":[{"name":"t1","level":'), size, F.lit('},{"name":"","level":1}],"facets":[{"id":0,"name":"'),
        F.col("p_name"), F.lit('","gradient_id":1,"deprecated":'),
        F.element_at(F.array(F.lit("true"), F.lit('"false"'), F.lit("[]"), F.lit("null")), F.col("p_size") % 4 + 1),
        F.lit('},{"id":1,"name":""}]}}'))
    return p.select(text.alias("j"))


@query("""SELECT 'h' || p_partkey AS owner, 1 AS slot, 'x' || p_size AS ability FROM part
    UNION ALL SELECT 'h' || p_partkey, 2, 'z' || p_size FROM part""")
def build_item_abilities(spark, d):
    return dimensions.build_item_abilities(_kit_docs(spark, d), "j")


@query("SELECT 'h' || p_partkey AS owner, 't1' AS ability, p_size AS level FROM part WHERE p_size BETWEEN 1 AND 4")
def build_item_talents(spark, d):
    return dimensions.build_item_talents(_kit_docs(spark, d), "j")


@query("SELECT 'h' || p_partkey AS owner, 0 AS slot, p_name AS name, 1 AS gradient_id, p_size % 4 IN (0, 1) AS deprecated FROM part")
def build_item_facets(spark, d):
    return dimensions.build_item_facets(_kit_docs(spark, d), "j").select("owner", "slot", "name", "gradient_id", "deprecated")


@query("""SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS name, n_regionkey = 1 AS balanced FROM nation""")
def build_codes(spark, d):
    """The id stands in the value for regions other than 2, else in the key."""
    n = load(spark, d, "nation")
    ident = F.when(F.col("n_regionkey") != 2, F.col("n_nationkey")).otherwise(0)
    value = F.struct(ident.alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") == 1).alias("balanced"))
    return dimensions.build_codes(_map_of(n, F.concat(F.lit(" "), F.col("n_nationkey").cast("string")), value), "j")


@query("SELECT CAST(r_regionkey AS INTEGER) AS id, r_name AS name FROM region")
def build_regions(spark, d):
    r = load(spark, d, "region")
    return dimensions.build_regions(_map_of(r, F.col("r_regionkey").cast("string"), F.col("r_name")), "j")


@query("""SELECT CAST(p_partkey AS INTEGER) AS id, 'k' || p_partkey AS key, p_name AS dname, p_size AS cost, p_brand AS qual,
    CASE WHEN p_size % 2 = 0 THEN p_size || '/' || p_size ELSE '' END AS cooldown FROM part WHERE p_partkey > 0""")
def build_gear(spark, d):
    p = load(spark, d, "part")
    s = F.col("p_size").cast("string")
    cd = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('["'), s, F.lit('","'), s, F.lit('"]'))).otherwise(F.lit("false"))
    value = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("dname"), F.col("p_size").alias("cost"),
                     F.col("p_brand").alias("qual"), F.parse_json(cd).alias("cd"))
    return dimensions.build_gear(_map_of(p, F.concat(F.lit("k"), F.col("p_partkey").cast("string")), value), "j").select(
        "id", "key", "dname", "cost", "qual", "cooldown")


@query("SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part")
def build_gear_ids(spark, d):
    p = load(spark, d, "part")
    return dimensions.build_gear_ids(_map_of(p, F.col("p_partkey").cast("string"), F.col("p_name")), "j")


@query("""SELECT CAST(o_orderkey AS INTEGER) AS season_id, 's' || o_orderkey AS season_name, CAST(epoch(o_orderdate) AS BIGINT) AS release_at
    FROM orders WHERE o_orderkey > 0""")
def build_seasons(spark, d):
    """Dates as number, numeric text, RFC 3339, plain date or list, by order priority."""
    c = star.contests(spark, d)
    day = F.date_format(F.date_from_unix_date((F.col("start_time") / 86400).cast("int")), "yyyy-MM-dd")
    t = F.col("start_time").cast("string")
    date = (F.when(F.col("lobby") == 1, t).when(F.col("lobby") == 2, F.concat(F.lit('"'), t, F.lit('"')))
            .when(F.col("lobby") == 3, F.concat(F.lit('"'), day, F.lit('T02:00:00+02:00"')))
            .when(F.col("lobby") == 4, F.concat(F.lit('"'), day, F.lit('"'))).otherwise(F.concat(F.lit("["), t, F.lit("]"))))
    ident = F.col("contest_id").cast("string")
    j = F.concat(F.lit('[{"id":'), ident, F.lit(',"name":"s'), ident, F.lit('","date":'), date, F.lit("}]"))
    return dimensions.build_seasons(c.select(j.alias("j")), "j")


@query(sql("line_steps contests", """SELECT item_id, pub_pick, pub_win, CASE WHEN pub_pick > 0 THEN pub_win / CAST(pub_pick AS DOUBLE) END
      AS pub_win_rate, pro_pick, pro_win, CASE WHEN pro_pick > 0 THEN pro_win / CAST(pro_pick AS DOUBLE) END AS pro_win_rate FROM (
    SELECT item_id, count_if(league_id = 0 AND is_pick) AS pub_pick, count_if(league_id = 0 AND is_pick AND side0_won) AS pub_win,
      count_if(league_id > 0 AND is_pick) AS pro_pick, count_if(league_id > 0 AND is_pick AND side0_won) AS pro_win
    FROM line_steps JOIN contests USING (contest_id) GROUP BY 1)"""))
def build_item_stats(spark, d):
    c = star.contests(spark, d).select("contest_id", "league_id", "side0_won")
    rows = star.line_steps(spark, d).join(c, "contest_id")
    won = F.coalesce("side0_won", F.lit(False))
    stats = rows.groupBy("item_id").agg(
        F.count_if((F.col("league_id") == 0) & F.col("is_pick")).alias("pub_pick"),
        F.count_if((F.col("league_id") == 0) & F.col("is_pick") & won).alias("pub_win"),
        F.count_if((F.col("league_id") > 0) & F.col("is_pick")).alias("pro_pick"),
        F.count_if((F.col("league_id") > 0) & F.col("is_pick") & won).alias("pro_win"))
    return dimensions.build_item_stats(stats)


@query("""SELECT l_partkey AS item_id, 'unknown_' || l_partkey AS name, 'Unknown Hero ' || l_partkey AS item_name FROM (
    SELECT l_partkey FROM lineitem UNION SELECT l_suppkey FROM lineitem) WHERE l_partkey <> 0
    AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def stub_items(spark, d):
    l = load(spark, d, "lineitem")
    known = load(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("item_id"))
    return dimensions.stub_items([l.select(F.col("l_partkey").alias("item_id")), l.select(F.col("l_suppkey").alias("item_id"))], known)


_STUBS = """SELECT p_partkey AS item_id, 'unknown_' || p_partkey AS name, CAST(100 * p_size AS BIGINT) AS age FROM part WHERE p_size % 2 = 0"""


def _stub_dim(spark, d):
    p = load(spark, d, "part")
    name = F.concat(F.when(F.col("p_size") % 2 == 0, "unknown_").otherwise("known_"), F.col("p_partkey").cast("string"))
    return p.select(F.col("p_partkey").alias("item_id"), name.alias("name"),
                    (1_000_000 - 100 * F.col("p_size").cast("bigint")).alias("updated_at"))


@query(f"SELECT * FROM ({_STUBS}) WHERE age > 3600")
def stale_stubs(spark, d):
    return dimensions.stale_stubs(_stub_dim(spark, d), 1_000_000)


@query(f"""SELECT * FROM ({_STUBS}) WHERE age > 360000 UNION ALL SELECT 0, 'ALL_STUBS_CURRENT', 0
    WHERE NOT EXISTS (SELECT 1 FROM ({_STUBS}) WHERE age > 360000)""")
def stale_stubs_none(spark, d):
    return dimensions.stale_stubs(_stub_dim(spark, d), 1_000_000, 360_000)


@query("""SELECT coalesce(s_suppkey, c_custkey) AS account_id, coalesce(s_name, c_name) AS name,
    nullif(coalesce(s_nationkey, c_nationkey), 0) AS team_id, CASE WHEN s_suppkey IS NOT NULL THEN 'pro' ELSE 'pub' END AS country,
    s_suppkey IS NOT NULL AS is_pro FROM customer FULL JOIN supplier ON s_suppkey = c_custkey""")
def notable_players(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name"),
                                          F.col("c_nationkey").alias("team_id"), F.lit("pub").alias("country"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("account_id"), F.col("s_name").alias("name"),
                                          F.col("s_nationkey").alias("team_id"), F.lit("pro").alias("country"))
    return dimensions.notable_players(c, s)


# --- scalar rules over whole columns -------------------------------------------------------

@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type <> 'error' THEN props END AS blob,
    CASE WHEN value > 50 THEN round(value / 50, 6) END AS ratio FROM events""")
def event_props(spark, d):
    """JSON null and blank to NULL, a field out of a JSON text, and a guarded ratio."""
    e = load(spark, d, "events")
    blob = F.when(F.col("event_type") == "error", F.lit(" null ")).otherwise(F.col("props"))
    return e.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                    json_or_null(blob).alias("blob"),
                    F.round(guarded_ratio("value", F.when(F.col("value") > 50, 50).otherwise(0)), 6).alias("ratio"))


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || '/' || p_brand ELSE '' END AS as_text,
    CASE p_size % 4 WHEN 0 THEN '["' || p_name || '"]' WHEN 1 THEN '["' || p_name || '","' || p_brand || '"]'
      WHEN 2 THEN '[' || p_size || ']' ELSE '[]' END AS as_array,
    CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name ELSE '' END AS first_text,
    p_size % 4 IN (0, 1) AS flag, CASE p_size % 4 WHEN 2 THEN CAST(p_size AS BIGINT) END AS epoch FROM part""")
def polymorphic_values(spark, d):
    p = load(spark, d, "part")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = F.col("p_size") % 4
    text = (F.when(kind == 0, q("p_name")).when(kind == 1, F.concat(F.lit("["), q("p_name"), F.lit(","), q("p_brand"), F.lit("]")))
            .when(kind == 2, F.col("p_size").cast("string")).otherwise(F.lit("null")))
    v = F.parse_json(text)
    return p.select("p_partkey", poly_text(v).alias("as_text"), poly_array(v).alias("as_array"),
                    poly_first(v).alias("first_text"), poly_flag(v).alias("flag"), flex_epoch(v).alias("epoch"))


@query(sql("contests", "SELECT contest_id, year(to_timestamp(start_time)) || '_q' || quarter(to_timestamp(start_time)) AS quarter FROM contests"))
def quarter_names(spark, d):
    return star.contests(spark, d).select("contest_id", quarter_of("start_time").alias("quarter"))
