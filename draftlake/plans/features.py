"""Candidates with the features asked for.

Candidates multiply the decisions about thirty-fold, so nothing is joined or shuffled at that width. Everything a
feature depends on is brought to the *contest* row first: a team's profile and a partner's pair rates are maps over the
item catalogue, a roster is a short list of such maps. The contest row meets its decisions on the contest id, and the
lookups for all candidates of a decision happen inside the row. Only then are the candidates unfolded; what is left is a
broadcast of the item cards and arithmetic in generated code. Which of these are joined depends on the features.

Rates are averaged as whole millionths, so a mean does not depend on the order rows arrived in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import MILLION, attr_code, millionths, role_count
from draftlake.operators.filters import is_competitive
from draftlake.operators.joins import salted_lookup
from draftlake.operators.pairs import both_directions
from draftlake.plans.decisions import NEGATIVES, SPLIT_SEED, candidate_arrays
from draftlake.plans.feature_registry import DEFAULT, ROSTER, FeatureRegistry
from draftlake.sources.tables import spread

# The 24 feature names in their order.
FEATURES = list(DEFAULT.features)

COUNT_UNIT = 1 << 40  # rates are millionths, so their sum over a roster stays far below this
PARTNER_SALTS = 8


@dataclass(frozen=True)
class FeatureTables:
    """Profiles and dimensions the features look up, all as produced by the profile operators.

    ``contests`` (contest_id, team0, team1) and ``seats`` (contest_id, side, account_id) say who plays; without
    ``seats`` they are the known accounts of the competitive contests among ``players``. ``actors_known`` is False, or a
    condition that is false, when no actor profile exists at all.
    """

    contests: DataFrame
    players: DataFrame
    items: DataFrame
    team_item: DataFrame
    synergy: DataFrame
    counter: DataFrame
    actor_item: DataFrame
    item_global: DataFrame
    priors: DataFrame
    total_picks: DataFrame
    actors_known: bool | Column = True
    seats: DataFrame | None = None


# --- per-contest context ------------------------------------------------------------------

def team_maps(team_item: DataFrame, key: str, out: str) -> DataFrame:
    """Profile of a team as a map over items; at most one entry per catalogue item."""
    entry = F.struct("item_id", F.struct("games", "shrunk_wr"))
    return team_item.groupBy(F.col("team_id").alias(key)).agg(F.map_from_entries(F.collect_list(entry)).alias(out))


def actor_maps(actor_item: DataFrame) -> DataFrame:
    """Profile of an actor as a map from items to rates in millionths, and the actor's best rate; plain numbers travel light."""
    ppm = millionths("shrunk_wr").cast("int")
    return actor_item.groupBy("account_id").agg(
        F.map_from_entries(F.collect_list(F.struct("item_id", ppm.alias("ppm")))).alias("rates"), F.max("shrunk_wr").alias("best"))


def stored_seats(players: DataFrame) -> DataFrame:
    return players.filter(is_competitive() & F.col("won").isNotNull() & F.col("account_id").isNotNull()).select("contest_id", "side", "account_id")


def roster_context(seats: DataFrame, actor_item: DataFrame, maps: bool = True) -> DataFrame:
    """Per contest and side: the actors' rate maps (if wanted), their number, and the mean of their best rates."""
    profiles = actor_maps(actor_item) if maps else actor_item.groupBy("account_id").agg(F.max("shrunk_wr").alias("best"))
    best = millionths(F.coalesce("best", F.lit(0.5))).cast("int")
    rows = salted_lookup(seats, profiles, "account_id", "contest_id").withColumns({"known": F.col("account_id").isNotNull(), "best": best})
    # Dealt one by one: seats of a contest hardly meet before the shuffle, and an actor's seats are alike, one after the other.
    rows = spread(rows.drop("account_id"), "contest_id")

    def of(side: int, c) -> Column:
        return F.when(F.col("side") == side, c)

    aggs = []
    for s in (0, 1):
        n = F.count_if(of(s, F.col("known")))
        aggs += [F.collect_list(of(s, F.col("rates"))).alias(f"maps{s}")] if maps else []
        aggs += [n.alias(f"n{s}"), (F.sum(of(s, F.col("best"))) / n / MILLION).alias(f"threat{s}")]
    return rows.groupBy("contest_id").agg(*aggs)


def contest_context(ft: FeatureTables, needs: set[str]) -> DataFrame | None:
    """One row per contest with the teams' item maps and the rosters, as far as they are needed."""
    teams, out = bool(needs & {"own_team", "opp_team"}), None
    if teams:
        out = ft.contests.select("contest_id", "team0", "team1")
        for key in ("team0", "team1"):
            out = salted_lookup(out, team_maps(ft.team_item, key, key.replace("team", "team_map")), key, "contest_id")
        out = out.drop("team0", "team1")
    if needs & {"comfort", "roster_threat"}:
        seats = stored_seats(ft.players) if ft.seats is None else ft.seats
        rosters = roster_context(seats, ft.actor_item, "comfort" in needs)
        out = out.join(rosters, "contest_id", "left") if teams else rosters
    return out


# --- pair rates ---------------------------------------------------------------------------

def partner_rates(ft: FeatureTables, needs: set[str]) -> DataFrame:
    """One row per partner: rates of items with it (``synergy``) and against it (``counter``), and its own rate.

    Rates are arrays indexed by item id, so a look-up is one step whatever the catalogue. Ids are two-byte numbers: an
    array has at most 32768 places, and there is at most one row per catalogue item. A small table is broadcast by the
    optimizer's size check.
    """
    kinds = [k for k in ("synergy", "counter") if k in needs]
    rates = {"synergy": both_directions(ft.synergy).select(F.col("partner_id").alias("partner"), "item_id", millionths("shrunk_wr").alias("ppm")),
             "counter": ft.counter.select(F.col("item_b").alias("partner"), F.col("item_a").alias("item_id"), millionths("shrunk_wr").alias("ppm"))}
    known, none = None, F.lit(None).cast("bigint")
    for kind in kinds:
        rows = rates[kind].select("partner", "item_id", *[(F.col("ppm") if k == kind else none).alias(k) for k in kinds])
        known = rows if known is None else known.unionByName(rows)
    known = known.groupBy("partner", "item_id").agg(*[F.max(k).cast("int").alias(k) for k in kinds])
    # One place for every id up to the largest, so that the sorted list is an array by id.
    gaps = known.groupBy("partner").agg(F.max("item_id").alias("_last")).select(
        "partner", F.explode(F.sequence(F.lit(0), F.col("_last").cast("int"))).alias("item_id"), *[F.lit(None).cast("int").alias(k) for k in kinds])
    full = known.select("partner", F.col("item_id").cast("int"), *kinds).unionByName(gaps) \
        .groupBy("partner", "item_id").agg(*[F.max(k).alias(k) for k in kinds])
    listed = full.groupBy("partner").agg(F.sort_array(F.collect_list(F.struct("item_id", *kinds))).alias("_all"))
    arrays = listed.select("partner", *[F.col(f"_all.{k}").alias(k) for k in kinds])
    own = ft.item_global.select(F.col("item_id").alias("partner"), millionths("shrunk_wr").cast("int").alias("own"))
    return own.join(arrays, "partner", "full_outer")


def contest_partners(decided: DataFrame, ft: FeatureTables, needs: set[str]) -> DataFrame:
    """Per contest a map from each item drafted by either side to its pair rates: at most ten entries.

    Partners are the few distinct picks of a contest. A popular item is spread over the salts, so it is no hot key. The rows
    go to their contests as the join leaves them, by partner: equal arrays follow each other and shrink to little in the shuffle.
    """
    seen = decided.select("contest_id", F.explode(F.array_union("allies", "enemies")).alias("partner")).distinct() \
        .withColumn("_salt", F.pmod(F.xxhash64("contest_id"), F.lit(PARTNER_SALTS)).cast("int"))
    rates = partner_rates(ft, needs).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PARTNER_SALTS - 1))))
    fields = [c for c in rates.columns if c not in ("partner", "_salt")]
    joined = spread(seen.join(rates.hint("merge"), ["partner", "_salt"], "left").drop("_salt"), "contest_id")
    return joined.groupBy("contest_id").agg(F.map_from_entries(F.collect_list(F.struct("partner", F.struct(*fields)))).alias("partner_map"))


# --- item cards ---------------------------------------------------------------------------

def item_cards(ft: FeatureTables, needs: set[str]) -> DataFrame | None:
    """What is needed of attribute, roles, global rate and priors per item: one row per two-byte id."""
    parts = []
    if "meta" in needs:
        parts.append(ft.items.select("item_id", attr_code("primary_attr").alias("attr"), role_count("roles").alias("roles_n")))
    if "global" in needs:
        parts.append(ft.item_global.select("item_id", F.col("picks").alias("g_picks"), F.col("shrunk_wr").alias("g_rate")))
    if "priors" in needs:
        parts.append(ft.priors.select("item_id", "item_pick_rate", "item_wr", F.round("item_popularity", 6).alias("item_popularity")))
    if not parts:
        return None
    # Only items of the catalogue have cards: unknown ones fall back, also where some profile knows them.
    cards = ft.items.select("item_id").filter(F.col("item_id").between(1, 32767))
    for p in parts:
        cards = cards.join(p, "item_id", "left")
    return F.broadcast(cards)  # at most 32767 rows: two-byte ids, one row each


# --- assembly -----------------------------------------------------------------------------

def _of_side(own: bool, name: str) -> Column:
    first, second = (f"{name}0", f"{name}1") if own else (f"{name}1", f"{name}0")
    return F.when(F.col("side") == 0, F.col(first)).otherwise(F.col(second))


KEEP = ["contest_id", "season_id", "slot", "is_pick", "side", "acting_team", "opp_team", "acting_won", "team_picks_before", "enemy_picks_before"]


def unfolded(decided: DataFrame, ft: FeatureTables, needs: set[str]) -> DataFrame:
    """One row per candidate of each decision with the looked-up inputs; the candidates are never shuffled.

    ``decided`` holds ``pool`` (candidates, with ``chosen`` true when the first is the item really taken), ``allies`` and
    ``enemies``.
    """
    rows, keep = decided, [c for c in KEEP if c in decided.columns]
    context = contest_context(ft, needs)
    if context is not None:
        rows = rows.join(context, "contest_id", "left")
    pairs = [k for k in ("synergy", "counter") if k in needs]
    if pairs:
        rows = rows.join(contest_partners(decided, ft, needs), "contest_id", "left")

    # What the lookups of one decision share, computed once per row.
    shared, extra = {"pool": F.col("pool")}, []
    if "own_team" in needs:
        shared["own"] = _of_side(True, "team_map")
    if "opp_team" in needs:
        shared["opp"] = _of_side(False, "team_map")
    if "comfort" in needs:
        shared["actors"] = _of_side(True, "maps")
        extra.append(F.coalesce(_of_side(True, "n"), F.lit(0)).alias("n_actors"))
    if "roster_threat" in needs:
        extra.append(F.coalesce(_of_side(False, "threat"), F.lit(0.5)).alias("roster_threat"))
    for kind in pairs:
        shared[kind] = F.transform("allies" if kind == "synergy" else "enemies", lambda p: F.col("partner_map")[p])

    zero = F.lit(0).cast("bigint")

    def mean_rate(partners: Column, kind: str, item: Column) -> Column:
        """Mean over the partners; a pair never seen counts with the partner's own rate, then one half."""
        total = F.aggregate(partners, zero, lambda acc, p: acc + F.coalesce(F.get(p[kind], item), p["own"], F.lit(MILLION // 2)))
        return F.when(F.size(partners) > 0, total / F.size(partners) / MILLION)

    def look_up(w: Column, item: Column, label: Column) -> Column:
        fields = [item.alias("item_id"), label.alias("label")]
        fields += [w[k][item].alias(k) for k in ("own", "opp") if k in shared]
        if "actors" in shared:
            # One look into each map; a known rate adds itself, and one count in the high half.
            fields.append(F.aggregate(w["actors"], zero, lambda acc, m: acc + F.coalesce(m[item] + COUNT_UNIT, zero)).alias("known"))
        fields += [mean_rate(w[k], k, item).alias(k) for k in pairs]
        return F.struct(*fields)

    one = F.array(F.struct(*[c.alias(k) for k, c in shared.items()]))
    label = F.when(F.col("chosen"), 0).otherwise(-1)
    found = F.transform(one, lambda w: F.transform(w["pool"], lambda i, at: look_up(w, i, F.when(at == label, 1.0).otherwise(0.0))))[0]
    out = rows.select(*keep, *extra, F.inline(found))
    if "actors" in shared:
        n = F.floor(F.coalesce("known", zero) / COUNT_UNIT)
        out = out.withColumn("known_actors", n).withColumn("known_sum", F.coalesce("known", zero) - n * COUNT_UNIT)
    for k, short in (("synergy", "syn"), ("counter", "ctr")):
        out = out.withColumnRenamed(k, short) if k in pairs else out
    return out


def featured(decided: DataFrame, ft: FeatureTables, features: list[str] | None = None, registry: FeatureRegistry = DEFAULT) -> DataFrame:
    """Unfolded candidates with the wanted features; only their inputs are joined."""
    names = FEATURES if features is None else features
    needs = registry.needs(names)
    cands = unfolded(decided, ft, needs)
    cards = item_cards(ft, needs)
    if cards is not None:
        cands = cands.join(cards, "item_id", "left")
    for name in sorted(needs & set(registry.inputs)):
        cands = registry.inputs[name](cands, ft)
    won = [F.col("acting_won")] if "acting_won" in cands.columns else []
    return cands.select(
        "contest_id", "slot", "side", F.coalesce("acting_team", F.lit(-1)).alias("acting_team"), F.coalesce("opp_team", F.lit(-1)).alias("opp_team"),
        *won, "item_id", "label", *[f.value(ft).cast("double").alias(f.name) for f in registry.chosen(names)])


def candidate_features(states: DataFrame, ft: FeatureTables, n: int | None = NEGATIVES, seed: int = SPLIT_SEED,
                       threat: str = "team", features: list[str] | None = None, registry: FeatureRegistry | None = None) -> DataFrame:
    """Candidates of every pick with the 24 features, or with those named.

    ``n=None`` gives the whole legal pool. ``threat`` selects the opponent-threat feature: of the
    opposing team on this item (``team``) or of the opposing roster's best items (``roster``).
    """
    decided = candidate_arrays(states, ft.items, n, seed)
    decided = decided.withColumn("pool", F.concat(F.array("item_id"), F.col("others"))).withColumn("chosen", F.lit(True)).drop("others", "drafted", "item_id")
    return featured(decided, ft, features, registry or (DEFAULT if threat == "team" else ROSTER))
