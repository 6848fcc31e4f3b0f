"""Draft sequences: encoding, grammar, era, digest, templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.functions.scalars import epoch_date
from draftlake.sources.tables import merge_contests

# The standard 24-slot template as (slot, phase, is_ban, side).
STANDARD_TEMPLATE = [
    (0, "ban_1", True, 0), (1, "ban_1", True, 0), (2, "ban_2", True, 1), (3, "ban_2", True, 1),
    (4, "ban_3", True, 0), (5, "ban_3", True, 1), (6, "ban_4", True, 1),
    (7, "pick_1", False, 0), (8, "pick_1", False, 1),
    (9, "ban_5", True, 0), (10, "ban_5", True, 0), (11, "ban_6", True, 1),
    (12, "pick_2", False, 1), (13, "pick_2", False, 0),
    (14, "pick_3", False, 0), (15, "pick_3", False, 1),
    (16, "pick_4", False, 1), (17, "pick_4", False, 0),
    (18, "ban_7", True, 0), (19, "ban_7", True, 1), (20, "ban_8", True, 0), (21, "ban_8", True, 1),
    (22, "pick_5", False, 0), (23, "pick_5", False, 1),
]

# Draft eras, newest first, as (name, length, pattern of a whole draft, pattern of
# a draft or of its beginning). B is a ban, P a pick; bans may be declined, picks may not.
ERAS = [
    ("7_33_plus", 24, "^B{0,7}P{2}B{0,3}P{6}B{0,4}P{2}$",
     "^B{0,7}(P{0,1}|P{2}B{0,3}(P{0,5}|P{6}B{0,4}P{0,2}))$"),
    ("7_30_to_7_32", 24, "^B{0,4}P{4}B{0,6}P{4}B{0,4}P{2}$",
     "^B{0,4}(P{0,3}|P{4}B{0,6}(P{0,3}|P{4}B{0,4}P{0,2}))$"),
    ("pre_7_30", 20, "^B{0,4}P{6}B{0,6}P{4}$",
     "^B{0,4}(P{0,5}|P{6}B{0,6}P{0,4})$"),
]
MIN_STEPS, MAX_STEPS, PICKS_PER_DRAFT = 16, 24, 10

_BITS = 62  # slots 0..62 travel as bits of a bigint


def standard_template(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STANDARD_TEMPLATE, "slot int, phase string, is_ban boolean, side int")


def draft_sequences(steps: DataFrame) -> DataFrame:
    """One row per contest: step count, pick count and the ordered steps.

    The order is carried by bit masks with a fixed-size state, so partial aggregation shrinks
    every contest on the map side and an oversized one costs no more than any other. Slots
    outside the mask range are kept in a list beside it; (contest, slot) is the table's key, so
    that list is limited by the slot type. A repeated slot shows as ``repeated_slot``.
    """
    slot = F.col("slot").cast("int")
    inside = slot.between(0, _BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(inside, slot).otherwise(0))

    def mask(cond: Column) -> Column:
        return F.coalesce(F.bit_or(F.when(inside & cond, bit)), F.lit(0).cast("bigint"))

    entry = F.struct(slot.alias("slot"), F.col("is_pick").alias("is_pick"), F.col("side").cast("int").alias("side"))
    agg = steps.groupBy("contest_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.count_if("is_pick").alias("n_picks"),
        F.max(F.when(inside, slot)).alias("_last"),
        mask(F.lit(True)).alias("_seen"),
        mask(F.col("is_pick")).alias("_pick"),
        mask(F.col("side") == 1).alias("_side"),
        F.collect_list(F.when(~inside, entry)).alias("_far"),
    )

    def has(mask_col: str, i: Column) -> Column:
        return F.expr(mask_col).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)) != 0

    near = F.transform(
        F.filter(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0))), lambda i: has("_seen", i)),
        lambda i: F.struct(i.alias("slot"), has("_pick", i).alias("is_pick"),
                           F.when(has("_side", i), 1).otherwise(0).alias("side")))
    ordered = F.when(F.size("_far") == 0, near).otherwise(F.sort_array(F.concat(near, F.col("_far"))))
    out = agg.select(
        "contest_id", "n_steps", "n_picks", ordered.alias("seq"),
        (F.bit_count("_seen") + F.size("_far") != F.col("n_steps")).alias("repeated_slot"))
    return out.withColumn(
        "code", F.array_join(F.transform("seq", lambda s: F.when(s["is_pick"], "P").otherwise("B")), ""))


def draft_fault(n_steps: str = "n_steps", n_picks: str = "n_picks", code: str = "code") -> Column:
    """Why a sequence is no valid draft, or null: its length, its pick count, its pattern."""
    shape = F.lit(False)
    for _, _, whole, _ in ERAS:
        shape = shape | F.col(code).rlike(whole)
    return (F.when(~F.col(n_steps).between(MIN_STEPS, MAX_STEPS), "length")
            .when(F.col(n_picks) != PICKS_PER_DRAFT, "pick_count")
            .when(~shape, "pattern"))


def draft_era(n_steps: str = "n_steps", code: str = "code") -> Column:
    """Era with the fewest declined bans, newest first; a beginning of a draft matches too."""
    options = []
    for rank, (name, length, _, beginning) in enumerate(ERAS):
        gap = F.lit(length) - F.col(n_steps)
        fits = F.col(code).rlike(beginning) & (F.col(n_steps) > 0) & (gap <= F.col(n_steps))
        options.append(F.when(fits, F.struct(gap.alias("gap"), F.lit(rank).alias("rank"), F.lit(name).alias("name"))))
    return F.coalesce(F.array_min(F.array(*options))["name"], F.lit("unknown"))


def sequence_digest(seq: str = "seq") -> Column:
    """SHA-256 of the ordered ``side:action|`` steps."""
    text = F.array_join(F.transform(seq, lambda s: F.concat(
        s["side"].cast("string"), F.lit(":"), F.when(s["is_pick"], "pick").otherwise("ban"), F.lit("|"))), "")
    return F.sha2(text, 256)


def validate_drafts(steps: DataFrame) -> DataFrame:
    return draft_sequences(steps).select(
        "contest_id", "n_steps", "n_picks", "code",
        draft_fault().alias("fault"), draft_era().alias("era"), sequence_digest().alias("digest"))


def format_canary(steps: DataFrame, contests: DataFrame) -> DataFrame:
    """Contests per day, era and sequence digest, to notice a new draft format."""
    seqs = validate_drafts(steps)
    days = contests.select("contest_id", epoch_date("start_time").alias("day"))
    return seqs.join(days, "contest_id").groupBy("day", "era", "digest").agg(
        F.count(F.lit(1)).alias("n_contests"), F.count_if(F.col("fault").isNotNull()).alias("n_invalid"))


# --- empirical template -------------------------------------------------------------------

def newest_season_sample(contests: DataFrame, n: int | None = None) -> DataFrame:
    """Contests of the newest season: all, or the lowest ``n`` ids where a sample is asked for."""
    newest = contests.agg(F.max("season_id").alias("m"))
    found = contests.filter(F.col("season_id") == newest.scalar()).select("contest_id")
    return found if n is None else found.orderBy("contest_id").limit(n)


def slot_template(steps: DataFrame, sample: DataFrame) -> DataFrame:
    """Most common side per slot (the lower one wins a tie) and whether all agree on the action."""
    return merge_contests(steps, sample, "left_semi").groupBy("slot").agg(
        F.expr("mode() within group (order by side)").alias("side_mode"),
        F.bool_and("is_pick").alias("all_picks"),
        (F.count_distinct("is_pick") == 1).alias("consistent"))


def slot_disagreements(steps: DataFrame, sample: DataFrame) -> DataFrame:
    return merge_contests(steps, sample, "left_semi").groupBy("slot").agg(
        F.count_distinct("is_pick").alias("n_actions")).filter("n_actions > 1")


def slot_side_anomalies(steps: DataFrame, sample: DataFrame) -> DataFrame:
    odd = merge_contests(steps, sample, "left_semi").filter(~F.col("side").isin(0, 1))
    return odd.groupBy("slot").agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_set("side")), lambda s: s.cast("string"))).alias("sides"))


def template_pattern(template: DataFrame) -> DataFrame:
    return template.select(
        "slot", F.when(F.col("all_picks"), "PICK").otherwise("BAN").alias("action"),
        F.when(F.col("side_mode") == 0, "side 0").otherwise("side 1").alias("side_name"), "side_mode")


def verify_template(steps: DataFrame, sample: DataFrame) -> DataFrame:
    """Named checks of the empirical template, and one ANOMALY row per odd slot."""
    agg = slot_template(steps, sample).agg(
        F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"),
        F.bool_and("consistent").alias("consistent"),
        F.bool_and(F.col("side_mode").isin(0, 1)).alias("sides_ok"),
        F.count_if("all_picks").alias("picks"), F.count_if(~F.col("all_picks")).alias("bans"))

    def verdict(cond: Column, bad: str = "FAIL") -> Column:
        return F.when(cond, "PASS").otherwise(bad)

    def check(name: str, status: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), status.alias("status"), detail.alias("detail"))

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    checks = agg.select(F.inline(F.array(
        check("SLOT_COUNT", verdict(F.col("n") == 24), F.concat(F.lit("slots: "), text("n"))),
        check("SLOT_CONTIGUITY",
              verdict((F.col("lo") == 0) & (F.col("hi") == 23) & (F.col("n") == 24)),
              F.concat(F.lit("slot range: "), text("lo"), F.lit(".."), text("hi"))),
        check("PICK_CONSISTENCY", verdict(F.col("consistent")), F.lit("every slot has one action")),
        check("TEAM_VALIDITY", verdict(F.col("sides_ok")), F.lit("every common side is 0 or 1")),
        check("PICK_BAN_TOTALS", verdict((F.col("picks") == 10) & (F.col("bans") == 14), "WARN"),
              F.concat(F.lit("picks: "), text("picks"), F.lit(", bans: "), text("bans"))),
    )))
    mixed = slot_disagreements(steps, sample).select(
        F.lit("DISAGREEMENT").alias("check_name"), F.lit("ANOMALY").alias("status"),
        F.concat(F.lit("mixed actions in slot "), F.col("slot").cast("string")).alias("detail"))
    odd = slot_side_anomalies(steps, sample).select(
        F.lit("TEAM_ANOMALY").alias("check_name"), F.lit("ANOMALY").alias("status"),
        F.concat(F.lit("slot "), F.col("slot").cast("string"), F.lit(" has sides "), F.col("sides")).alias("detail"))
    return checks.unionByName(mixed).unionByName(odd)
