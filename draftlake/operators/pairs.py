"""Item pairs inside a contest: synergy on one side, counter across sides.

Picks are first counted per (contest, side, item) with a map-side combine, so a contest never
contributes more entries than the catalogue has items, whatever its number of raw rows. A pair
is then worth the product of the two counts, which is what the self-join of the raw rows gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import MILLION, millionths, shrunk, side_won
from draftlake.operators.profiles import PRIOR_TEAM, DraftTables, eligible_picks, with_item_name


def _entries(t: DraftTables, as_of: str | None) -> DataFrame:
    """One row per contest with the counted picks of both sides."""
    counted = eligible_picks(t, as_of).groupBy("contest_id", "side0_won", "side", "item_id").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.groupBy("contest_id", "side0_won").agg(
        F.collect_list(F.struct("side", "item_id", "n")).alias("e"))


def _pair_rows(entries: DataFrame) -> DataFrame:
    outer = entries.select("side0_won", "e", F.explode("e").alias("a"))
    return outer.select("side0_won", "a", F.explode("e").alias("b"))


def _rates(pairs: DataFrame) -> DataFrame:
    weight = F.col("a.n") * F.col("b.n")
    won = side_won(F.col("a.side"), F.col("side0_won"))
    return (pairs.groupBy(F.col("a.item_id").alias("item_a"), F.col("b.item_id").alias("item_b"))
            .agg(F.sum(weight).alias("games"), F.sum(F.when(won, weight).otherwise(0)).alias("wins"))
            .withColumn("shrunk_wr", shrunk("wins", "games", PRIOR_TEAM)))


def _named(df: DataFrame, items: DataFrame) -> DataFrame:
    return with_item_name(with_item_name(df, items, "item_a", "item_a_name"), items, "item_b", "item_b_name")


def pair_synergy(t: DraftTables, as_of: str | None) -> DataFrame:
    """Unordered pairs picked by the same side, ``item_a < item_b``."""
    same = _pair_rows(_entries(t, as_of)).filter(
        (F.col("a.side") == F.col("b.side")) & (F.col("a.item_id") < F.col("b.item_id")))
    return _named(_rates(same), t.items)


def pair_counter(t: DraftTables, as_of: str | None) -> DataFrame:
    """Ordered pairs picked by opposite sides; both directions are rows of their own."""
    cross = _pair_rows(_entries(t, as_of)).filter(
        (F.col("a.side") != F.col("b.side")) & (F.col("a.item_id") != F.col("b.item_id")))
    return _named(_rates(cross), t.items)


def both_directions(synergy: DataFrame) -> DataFrame:
    """Every pair seen from both of its items."""
    forward = synergy.select(
        F.col("item_a").alias("item_id"), F.col("item_b").alias("partner_id"),
        F.col("item_b_name").alias("partner_name"), "games", "wins", "shrunk_wr")
    backward = synergy.select(
        F.col("item_b").alias("item_id"), F.col("item_a").alias("partner_id"),
        F.col("item_a_name").alias("partner_name"), "games", "wins", "shrunk_wr")
    return forward.unionByName(backward)


def pair_lookup(df: DataFrame, a: str, b: str, synergy: DataFrame) -> DataFrame:
    """Rate of an unordered pair through its normalised key; unseen pairs stay null."""
    rates = synergy.select(F.col("item_a").alias("_lo"), F.col("item_b").alias("_hi"),
                           F.col("shrunk_wr").alias("pair_wr"))
    keyed = df.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    return keyed.join(rates, ["_lo", "_hi"], "left").drop("_lo", "_hi")


def partner_means(cands: DataFrame, keys: list[str], partners: str, rates: DataFrame, item_rates: DataFrame,
                  out: str) -> DataFrame:
    """(keys, item_id, mean rate) of candidates with at least one partner; see mean_partner_rate."""
    spread = cands.select(*keys, "item_id", F.explode(partners).alias("partner_id"))
    known = (spread.join(rates, ["item_id", "partner_id"], "left")
             .join(item_rates.select(F.col("item_id").alias("partner_id"), F.col("shrunk_wr").alias("_own")),
                   "partner_id", "left"))
    ppm = millionths(F.coalesce("rate", "_own", F.lit(0.5)))
    return known.groupBy(*keys, "item_id").agg((F.sum(ppm) / F.count(F.lit(1)) / MILLION).alias(out))


def mean_partner_rate(cands: DataFrame, keys: list[str], partners: str, rates: DataFrame,
                      item_rates: DataFrame, out: str) -> DataFrame:
    """Mean rate of a candidate with an array of partners.

    ``rates`` holds (item_id, partner_id, rate); a pair never seen falls back to the partner's
    own rate and then to one half, and a candidate without partners gets one half. Works for a
    catalogue of any size; ``keys`` must identify a candidate row.
    """
    mean = partner_means(cands, keys, partners, rates, item_rates, out)
    joined = cands.join(mean, [*keys, "item_id"], "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(0.5)))
