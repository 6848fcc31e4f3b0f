"""Draft-shaped tables derived from the star schema.

Two variants exist. The *line* variant reads drafts out of order lines: the item is the brand,
the side comes from the supplier. The *sequence* variant gives every order a full 24-slot draft
by integer arithmetic on the order key.

Lines of an order are first reduced to one row per (order, item) with a map-side combine, so
the later per-contest windows see at most as many rows as there are brands, also when one
order holds a large share of all lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from draftlake.functions.scalars import epoch_of, known_id, side_won
from draftlake.operators.drafts import STANDARD_TEMPLATE
from draftlake.sources.tables import load, merge_contests, spread

ITEM_COUNT = 127
AS_OF = "2001-08-01"


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("contest_id"),
        epoch_of("o_orderdate").alias("start_time"),
        F.year("o_orderdate").alias("season_id"),
        F.when(status == "F", True).when(status == "O", False).alias("side0_won"),
        F.when(F.col("o_orderpriority") != "5-LOW", 1).otherwise(0).alias("league_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("lobby"),
        F.col("o_custkey").alias("team0"),
        (F.col("o_custkey") + 1).alias("team1"),
    )


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per year seen in the orders; a season is released on the first of January."""
    years = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("season_id")).distinct()
    return years.select(
        "season_id",
        F.concat(F.lit("season "), F.col("season_id").cast("string")).alias("season_name"),
        (F.unix_date(F.make_date("season_id", F.lit(1), F.lit(1))).cast("bigint") * 86400).alias("release_at"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select(
        "p_partkey", F.expr("cast(substring(p_brand, 7) as int)").alias("item_id"))
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def line_steps(spark: SparkSession, sf_dir: str, spread_contests: bool = False) -> DataFrame:
    """(contest_id, slot, is_pick, item_id, side) from order lines, one row per order and brand."""
    first = _lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("contest_id"), "item_id").agg(
        F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")).alias("f"))
    w = W.partitionBy("contest_id").orderBy("f.l_linenumber", "item_id")
    return (spread(first, "contest_id") if spread_contests else first).select(
        "contest_id",
        (F.row_number().over(w) - 1).alias("slot"),
        (F.col("f.l_returnflag") != "A").alias("is_pick"),
        "item_id",
        (F.col("f.l_suppkey") % 2).cast("int").alias("side"),
    )


def line_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contest_id, player_slot, account_id, item_id, side, start_time, lobby, side0_won ...)."""
    lines = _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("contest_id"),
        (F.col("l_partkey") % 2).cast("int").alias("side"),
        (F.col("l_linenumber") % 5).alias("seat"),
        F.struct("l_suppkey", "item_id").alias("f"),
    )
    seats = lines.groupBy("contest_id", "side", "seat").agg(F.min("f").alias("f"))
    return seats.select(
        "contest_id",
        (F.col("side") * 128 + F.col("seat")).alias("player_slot"),
        known_id("f.l_suppkey").alias("account_id"),
        F.col("f.item_id").alias("item_id"),
        "side",
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalogue of the line variant: one row per brand."""
    brand = F.expr("cast(substring(p_brand, 7) as int)")
    return load(spark, sf_dir, "part").groupBy(brand.alias("item_id")).agg(
        F.min("p_brand").alias("item_name"))


def _template_array(picks_only: bool = False) -> Column:
    rows = [r for r in STANDARD_TEMPLATE if not (picks_only and r[2])]
    seat = {0: 0, 1: 0}
    structs = []
    for slot, _, is_ban, side in rows:
        k = 0
        if not is_ban:
            k, seat[side] = seat[side], seat[side] + 1
        structs.append(F.struct(
            F.lit(slot).alias("slot"), F.lit(not is_ban).alias("is_pick"),
            F.lit(side).alias("side"), F.lit(k).alias("seat")))
    return F.array(*structs)


def _drafted_item(contest: Column, slot: Column) -> Column:
    """Distinct for the slots of one contest: the slot multiplier is a unit modulo a prime."""
    return ((slot * (contest % (ITEM_COUNT - 1) + 1) + contest) % ITEM_COUNT + 1).cast("int")


def sequence_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24-slot drafts; some bans are declined, every 13th draft has its first pick turned into a ban.

    Contests are dealt by id before they unfold, so work on whole drafts needs no shuffle of steps.
    """
    c = F.col("contest_id")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("contest_id"))
    steps = spread(o, "contest_id").select("contest_id", F.inline(_template_array()))
    return (
        steps.filter(F.col("is_pick") | ((c * 31 + F.col("slot") * 7) % 11 != 0))
        .select(
            "contest_id", "slot",
            (F.col("is_pick") & ~((F.col("slot") == 7) & (c % 13 == 0))).alias("is_pick"),
            _drafted_item(c, F.col("slot")).alias("item_id"),
            "side",
        )
    )


def sequence_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten actors per contest: seat k of a side plays that side's k-th pick."""
    c = F.col("contest_id")
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("contest_id"), F.col("o_custkey").alias("cust"))
    seats = spread(o, "contest_id").select("contest_id", "cust", F.inline(_template_array(picks_only=True)))
    return seats.select(
        "contest_id",
        (F.col("side") * 128 + F.col("seat")).alias("player_slot"),
        known_id((F.col("cust") + F.col("side")) * 5 + F.col("seat")).alias("account_id"),
        _drafted_item(c, F.col("slot")).alias("item_id"),
        "side",
    )


def sequence_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of 127 items folded from the parts: name, attribute and the roles seen."""
    item = (F.col("p_partkey") % ITEM_COUNT + 1).cast("int")
    attr = F.element_at(F.array(*[F.lit(a) for a in ("str", "agi", "int", "all", "")]), F.col("item_id") % 5 + 1)
    grouped = load(spark, sf_dir, "part").groupBy(item.alias("item_id")).agg(
        F.min("p_name").alias("item_name"), F.array_sort(F.collect_set("p_type")).alias("roles"))
    return grouped.select("item_id", "item_name", attr.alias("primary_attr"), "roles")


def with_contest(players: DataFrame, contests_df: DataFrame) -> DataFrame:
    """Player rows with the contest's time, season, lobby and the outcome of their side."""
    c = contests_df.select("contest_id", "start_time", "season_id", "lobby", "league_id", "side0_won")
    return merge_contests(players, c).withColumn("won", side_won("side", "side0_won")).drop("side0_won")


def contest_documents(spark: SparkSession, sf_dir: str, faulty: bool = False, full_drafts: bool = False) -> DataFrame:
    """Nested JSON documents of the line variant, or with ``full_drafts`` of the sequence variant, in a column ``raw``.

    A document holds at most 25 steps and ten players: both were reduced to one row per brand or
    seat before they are gathered. With ``faulty`` some documents of undecided orders break the
    validity rules, by lobby.
    """
    base = contests(spark, sf_dir)
    steps = sequence_steps(spark, sf_dir) if full_drafts else line_steps(spark, sf_dir, spread_contests=True)
    players = sequence_players(spark, sf_dir) if full_drafts else line_players(spark, sf_dir)
    slot, item = F.col("slot"), F.col("item_id")
    step_lists = steps.groupBy("contest_id").agg(F.sort_array(F.collect_list(F.struct(
        slot.alias("slot"), "is_pick", "item_id", "side"))).alias("s"))
    seats = players.groupBy("contest_id").agg(F.sort_array(F.collect_list(F.struct(
        "player_slot", "account_id", "item_id", "side"))).alias("p"))
    docs = base.join(step_lists, "contest_id").join(seats, "contest_id", "left")
    played = F.col("lobby") != 3
    undecided = F.col("side0_won").isNull() & F.lit(faulty)

    def curve(n: Column, factor: Column) -> Column:
        return F.when(played, F.transform(F.sequence(F.lit(1), n), lambda i: (i * factor).cast("int")))

    def player(p: Column) -> Column:
        seat = p["player_slot"] % 128
        won = side_won(p["side"], F.col("side0_won")).cast("int")
        return F.struct(
            F.when(undecided & (F.col("lobby") == 2), 99).otherwise(p["player_slot"]).alias("player_slot"),
            p["account_id"].alias("account_id"), p["item_id"].alias("hero_id"),
            (p["side"] == 0).alias("isRadiant"), won.alias("win"), F.col("season_id").alias("patch"),
            (p["item_id"] % 10).alias("kills"), (seat % 2).alias("firstblood_claimed"),
            curve(seat + 1, p["item_id"]).alias("gold_t"), curve(seat + 1, p["item_id"] * 7).alias("xp_t"),
            curve(seat + 2, p["item_id"] * 3000).alias("lh_t"), curve(seat + 3, F.lit(60)).alias("times"),
            F.when((seat == 0) & played, F.array(F.struct(F.lit(5).alias("time"), F.lit("potion").alias("key")))).alias("purchase_log"),
            F.struct(p["item_id"].alias("n")).alias("killed"))

    def step(s: Column) -> Column:
        return F.struct(s["slot"].alias("order"), s["is_pick"].alias("is_pick"), s["item_id"].alias("hero_id"),
                        F.when(undecided & (F.col("lobby") == 1), 2).otherwise(s["side"]).alias("team"))

    def timing(s: Column) -> Column:
        return F.struct(s["slot"].alias("order"), s["is_pick"].alias("pick"), s["side"].alias("active_team"),
                        F.when(s["is_pick"], s["item_id"]).otherwise(0).alias("hero_id"),
                        (s["slot"] * 3).alias("total_time_taken"))

    def objective(s: Column) -> Column:
        key = F.when(s["is_pick"], F.concat(F.lit('"k'), s["item_id"].cast("string"), F.lit('"'))).otherwise(
            s["item_id"].cast("string"))
        return F.struct((s["slot"] * 60).alias("time"), F.lit("building_kill").alias("type"), s["side"].alias("team"),
                        F.parse_json(key).alias("key"))

    def chat(s: Column) -> Column:
        return F.struct((s["slot"] * 10).alias("time"), F.lit("chat").alias("type"), s["side"].alias("player_slot"),
                        F.concat(F.lit("line "), s["item_id"].cast("string")).alias("key"))

    def fight(s: Column) -> Column:
        return F.struct((s["slot"] * 100).alias("end"), s["item_id"].alias("deaths"),
                        F.array(F.struct(s["side"].alias("side"))).alias("players"))

    c = F.col("contest_id")
    advantage = F.when(F.col("side0_won").isNotNull(), F.transform("s", lambda s: s["item_id"] * 10)).otherwise(
        F.array().cast("array<int>"))
    return docs.select(F.to_json(F.struct(
        c.alias("match_id"),
        F.when(~(undecided & (F.col("lobby") == 5)), F.col("start_time")).alias("start_time"),
        F.when(undecided & (F.col("lobby") == 4), -1).otherwise(600 + c % 3000).alias("duration"),
        F.col("side0_won").alias("radiant_win"), F.col("lobby").alias("lobby_type"), F.lit(2).alias("game_mode"),
        F.col("season_id").alias("patch"), F.col("league_id").alias("leagueid"),
        F.col("team0").alias("radiant_team_id"), F.col("team1").alias("dire_team_id"),
        (c % 50).alias("radiant_score"), F.lit("").alias("replay_url"),
        F.transform("p", player).alias("players"), F.transform("s", step).alias("picks_bans"),
        F.transform("s", timing).alias("draft_timings"), F.transform("s", objective).alias("objectives"),
        F.transform("s", chat).alias("chat"), F.transform("s", fight).alias("teamfights"),
        advantage.alias("radiant_gold_adv"), F.array().cast("array<int>").alias("radiant_xp_adv"),
        F.when(F.col("league_id") > 0, F.create_map(F.lit("1"), F.col("lobby"))).alias("cosmetics"),
    )).alias("raw"))
