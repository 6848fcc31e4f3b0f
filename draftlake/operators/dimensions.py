"""Reference tables from constants and entity feeds, with their cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import (
    attr_code, blank_to_null, flex_epoch, guarded_ratio, int_key, known_roles, poly_array, poly_first, poly_flag,
    poly_text, role_count,
)
from draftlake.operators.filters import is_stub_name
from draftlake.operators.joins import missing_keys
from draftlake.sources.envelopes import parse_constants, parse_entity_array

# Entries of the ability file that describe a schema, and the hidden ability.
SCHEMA_ABILITIES = ("special_bonus_attributes", "dota_base_ability")
HIDDEN_ABILITY = "generic_hidden"
MAX_TALENT_LEVEL = 4

ITEM_VALUE = """struct<id:int, name:string, localized_name:string, primary_attr:string, attack_type:string,
roles:array<string>, legs:int>"""
ABILITY_VALUE = """struct<dname:string, `desc`:string, img:string, mc:variant, cd:variant, target_team:variant,
behavior:variant, attrib:variant>"""
GEAR_VALUE = """struct<id:int, dname:string, cost:int, qual:string, behavior:variant, lore:string, img:string,
created:boolean, cd:variant, mc:variant>"""
KIT_VALUE = """struct<abilities:array<variant>, talents:array<struct<name:string, level:int>>,
facets:array<struct<id:int, name:string, title:string, description:string, icon:string, color:string,
gradient_id:int, deprecated:variant>>>"""
SEASON_FIELDS = "id int, name string, date variant"


def build_items(df: DataFrame, json_col: str) -> DataFrame:
    """The item catalogue: ids in the two-byte range, blank attribute to null."""
    v = parse_constants(df, json_col, ITEM_VALUE).select("value.*")
    return v.filter(F.col("id").between(1, 32767)).select(
        F.col("id").alias("item_id"), "name", F.col("localized_name").alias("item_name"),
        blank_to_null("primary_attr").alias("primary_attr"), "attack_type", "roles", "legs")


def duplicate_names(items: DataFrame) -> DataFrame:
    return items.groupBy("item_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique_names(items: DataFrame) -> DataFrame:
    dup = duplicate_names(items).limit(5).collect()
    if dup:
        raise ValueError("duplicate item names: " + ", ".join(sorted(str(r["item_name"]) for r in dup)))
    return items


def item_meta(items: DataFrame) -> DataFrame:
    return items.select("item_id", attr_code("primary_attr").alias("attr"), role_count("roles").alias("roles_n"),
                        known_roles("roles").alias("known_roles"))


def build_abilities(df: DataFrame, json_col: str) -> DataFrame:
    a = parse_constants(df, json_col, ABILITY_VALUE).filter(
        (F.col("key") != "") & ~F.col("key").isin(*SCHEMA_ABILITIES))
    v = lambda n: F.col(f"value.{n}")
    return a.select(
        F.col("key").alias("name"), v("dname").alias("localized"), v("desc").alias("description"), v("img").alias("img"),
        poly_text(v("mc")).alias("mana_cost"), poly_text(v("cd")).alias("cooldown"),
        poly_text(v("target_team")).alias("target_team"),
        poly_array(v("behavior")).alias("behavior"), poly_array(v("attrib")).alias("attrib"))


def parse_id_map(df: DataFrame, json_col: str, least: int) -> DataFrame:
    """(id, name) of a map from id text to name; unparsable and too small ids are skipped."""
    m = parse_constants(df, json_col, "string").select(int_key("key").alias("id"), F.col("value").alias("name"))
    return m.filter(F.col("id") >= least)


def attach_ability_ids(abilities: DataFrame, id_map: DataFrame) -> DataFrame:
    """Ability ids joined by name; an id without an ability makes a row of its own."""
    ids = id_map.filter(F.coalesce("name", F.lit("")) != "").groupBy("name").agg(F.max("id").alias("ability_id"))
    return abilities.join(ids, "name", "full_outer")


def build_item_abilities(df: DataFrame, json_col: str) -> DataFrame:
    """Ability per item and position; blank and hidden ones are skipped but keep their position."""
    kit = parse_constants(df, json_col, KIT_VALUE)
    rows = kit.select(F.col("key").alias("owner"), F.posexplode("value.abilities").alias("slot", "a"))
    return rows.select("owner", "slot", poly_first("a").alias("ability")).filter(
        (F.col("owner") != "") & ~F.col("ability").isin("", HIDDEN_ABILITY))


def build_item_talents(df: DataFrame, json_col: str) -> DataFrame:
    kit = parse_constants(df, json_col, KIT_VALUE)
    rows = kit.select(F.col("key").alias("owner"), F.inline("value.talents"))
    return rows.filter((F.col("owner") != "") & (F.col("name") != "") & F.col("level").between(1, MAX_TALENT_LEVEL)).select(
        "owner", F.col("name").alias("ability"), "level")


def build_item_facets(df: DataFrame, json_col: str) -> DataFrame:
    kit = parse_constants(df, json_col, KIT_VALUE)
    rows = kit.select(F.col("key").alias("owner"), F.explode("value.facets").alias("f"))
    return rows.filter((F.col("owner") != "") & (F.col("f.name") != "")).select(
        "owner", F.col("f.id").alias("slot"), "f.name", "f.title", "f.description", "f.icon", "f.color",
        "f.gradient_id", poly_flag("f.deprecated").alias("deprecated"))


def build_codes(df: DataFrame, json_col: str) -> DataFrame:
    """Game modes and lobby types: the id of the value, else of the key; blank names are dropped."""
    m = parse_constants(df, json_col, "struct<id:int, name:string, balanced:boolean>")
    ident: Column = F.coalesce(F.nullif(F.col("value.id"), F.lit(0)), int_key("key"))
    return m.select(ident.alias("id"), F.col("value.name").alias("name"),
                    F.coalesce("value.balanced", F.lit(False)).alias("balanced")).filter(
        F.col("id").isNotNull() & (F.coalesce("name", F.lit("")) != ""))


def build_regions(df: DataFrame, json_col: str) -> DataFrame:
    return parse_id_map(df, json_col, -(2 ** 31)).filter(F.coalesce("name", F.lit("")) != "")


def build_gear(df: DataFrame, json_col: str) -> DataFrame:
    g = parse_constants(df, json_col, GEAR_VALUE).filter((F.col("key") != "") & (F.col("value.id") > 0))
    v = lambda n: F.col(f"value.{n}")
    return g.select(v("id").alias("id"), F.col("key"), v("dname").alias("dname"), v("cost").alias("cost"),
                    v("qual").alias("qual"), poly_text(v("behavior")).alias("behavior"), v("lore").alias("lore"),
                    v("img").alias("img"), v("created").alias("created"),
                    poly_text(v("cd")).alias("cooldown"), poly_text(v("mc")).alias("mana_cost"))


def build_gear_ids(df: DataFrame, json_col: str) -> DataFrame:
    return parse_id_map(df, json_col, 0)


def build_seasons(df: DataFrame, json_col: str) -> DataFrame:
    """Seasons of a JSON list; the release date comes in four encodings."""
    s = parse_entity_array(df, json_col, SEASON_FIELDS)
    return s.filter((F.col("id") > 0) & (F.coalesce("name", F.lit("")) != "")).select(
        F.col("id").alias("season_id"), F.col("name").alias("season_name"), flex_epoch("date").alias("release_at"))


def build_item_stats(stats: DataFrame) -> DataFrame:
    """Public and professional win rates, null without picks."""
    return (stats.withColumn("pub_win_rate", guarded_ratio("pub_win", "pub_pick"))
            .withColumn("pro_win_rate", guarded_ratio("pro_win", "pro_pick")))


def stub_items(facts: list[DataFrame], items: DataFrame) -> DataFrame:
    """Placeholder rows for item ids that the facts use and the catalogue lacks."""
    ids = None
    for f in facts:
        part = f.select("item_id").distinct()
        ids = part if ids is None else ids.unionByName(part)
    missing = missing_keys(ids, "item_id", items, "item_id")
    text = F.col("key").cast("string")
    return missing.select(F.col("key").alias("item_id"), F.concat(F.lit("unknown_"), text).alias("name"),
                          F.concat(F.lit("Unknown Hero "), text).alias("item_name"))


def stale_stubs(dim: DataFrame, as_of_epoch, max_age: int = 3600) -> DataFrame:
    """Placeholders older than ``max_age`` seconds, else one ALL_STUBS_CURRENT row."""
    age = F.lit(as_of_epoch) - F.col("updated_at")
    old = dim.filter(is_stub_name("name")).select("item_id", "name", age.alias("age")).filter(F.col("age") > max_age)
    calm = old.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit(0).cast(dim.schema["item_id"].dataType).alias("item_id"),
        F.lit("ALL_STUBS_CURRENT").alias("name"), F.lit(0).cast("bigint").alias("age"))
    return old.unionByName(calm)


def notable_players(notable: DataFrame, pros: DataFrame) -> DataFrame:
    """Two feeds in one table: a professional entry overrides, and the flag stays once set."""
    both = notable.withColumn("is_pro", F.lit(False)).unionByName(pros.withColumn("is_pro", F.lit(True)))
    best = F.max_by(F.struct("name", "team_id", "country"), F.struct("is_pro", "name", "team_id", "country"))
    return both.groupBy("account_id").agg(best.alias("b"), F.bool_or("is_pro").alias("is_pro")).select(
        "account_id", "b.name", F.nullif(F.col("b.team_id"), F.lit(0)).alias("team_id"), "b.country", "is_pro")
