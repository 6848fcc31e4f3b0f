"""Column functions shared by the operators. All of them stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Attribute codes and the eight known roles.
ATTR_CODES = {"str": 1, "agi": 2, "int": 3, "all": 4}
KNOWN_ROLES = ["Carry", "Support", "Nuker", "Disabler", "Durable", "Escape", "Pusher", "Initiator"]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- sides and outcomes -------------------------------------------------------------------

def side_won(side, side0_won) -> Column:
    """Outcome seen from one side; an unknown outcome stays null."""
    side, won = as_col(side), as_col(side0_won)
    return F.when(side == 0, won).when(side == 1, ~won)


def won_flag(side, side0_won) -> Column:
    """1 for a known win of this side, else 0: an unknown outcome counts as a loss."""
    side, won = as_col(side), as_col(side0_won)
    return F.when(((side == 0) & won) | ((side == 1) & ~won), 1).otherwise(0)


def team_of(side, team0="team0", team1="team1") -> Column:
    return F.when(as_col(side) == 0, as_col(team0)).otherwise(as_col(team1))


def opponent_of(side, team0="team0", team1="team1") -> Column:
    return F.when(as_col(side) == 0, as_col(team1)).otherwise(as_col(team0))


def known_id(c) -> Column:
    """An absent id arrives as 0; treat it as null."""
    c = as_col(c)
    return F.when(c != 0, c)


def shrunk(wins, games, prior: float) -> Column:
    """Win rate pulled to one half by ``prior`` pseudo-wins and ``prior`` pseudo-losses."""
    return (as_col(wins) + F.lit(float(prior))) / (as_col(games) + F.lit(2.0 * prior))


MILLION = 1_000_000


def millionths(rate) -> Column:
    """A non-negative number in whole millionths; sums of these are exact in any order.

    Half rounds up. ``floor`` stays in generated arithmetic, where ``round`` of a double goes
    through a decimal text for every value.
    """
    return F.floor(as_col(rate) * MILLION + 0.5).cast("bigint")


# --- time (epoch seconds; independent of the session time zone) ---------------------------

def epoch_of(ts) -> Column:
    """Epoch seconds of a zone-less timestamp, reading its wall clock as UTC."""
    ts = as_col(ts)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * SECONDS_PER_DAY
        + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    ).cast("bigint")


def epoch_date(seconds) -> Column:
    return F.date_from_unix_date(F.floor(as_col(seconds) / SECONDS_PER_DAY).cast("int"))


def months_before(as_of: str, months: int) -> Column:
    """Epoch seconds of ``as_of`` minus calendar months; folds to a constant before the scan."""
    day = F.add_months(F.lit(as_of).cast("date"), -months)
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY


def quarter_of(seconds) -> Column:
    """Name of the UTC quarter holding an epoch second, such as ``1998_q3``."""
    day = epoch_date(seconds)
    return F.concat(F.year(day).cast("string"), F.lit("_q"), F.quarter(day).cast("string"))


def quarter_start(seconds) -> Column:
    return F.trunc(epoch_date(seconds), "quarter")


# --- blanks -------------------------------------------------------------------------------

def blank_to_null(c) -> Column:
    c = as_col(c)
    return F.when(F.trim(c) != "", c)


def json_or_null(c) -> Column:
    """JSON ``null`` and blank text become SQL NULL."""
    c = as_col(c)
    return F.when(~F.trim(c).isin("", "null"), c)


# --- polymorphic JSON (the argument is a VARIANT) -----------------------------------------

def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def poly_text(v) -> Column:
    """A string as it is, a list of strings joined by ``/``, everything else blank."""
    v = as_col(v)
    return F.coalesce(
        F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
        .when(_kind(v) == "ARRAY<STRING>", F.array_join(F.try_variant_get(v, "$", "array<string>"), "/")),
        F.lit(""),
    )


def poly_array(v) -> Column:
    """JSON text of a list: scalars are wrapped, lists and objects pass, null gives ``[]``."""
    v = as_col(v)
    text = F.to_json(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit("[]"))
        .when(F.substring(text, 1, 1).isin("[", "{"), text)
        .otherwise(F.concat(F.lit("["), text, F.lit("]")))
    )


def poly_first(v) -> Column:
    """A string, or the first string of a list, else blank."""
    v = as_col(v)
    return F.coalesce(
        F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
        .when(_kind(v) == "ARRAY<STRING>", F.try_variant_get(v, "$[0]", "string")),
        F.lit(""),
    )


def poly_flag(v) -> Column:
    """Truth of a flag that may be a boolean, a text (any non-empty one is true) or a list."""
    v = as_col(v)
    kind = _kind(v)
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .when(kind.startswith("ARRAY"), F.try_variant_get(v, "$[0]", "variant").isNotNull()),
        F.lit(False),
    )


def flex_epoch(v) -> Column:
    """Epoch seconds from a number, a numeric text, RFC 3339, a plain date, or a list that starts with a number."""
    v = as_col(v)
    kind = _kind(v)
    first = _kind(F.try_variant_get(v, "$[0]", "variant"))
    head = F.when(kind.startswith("ARRAY") & ~first.isin("STRING", "BOOLEAN"), F.try_variant_get(v, "$[0]", "double").cast("bigint"))
    number = F.when(~kind.startswith("ARRAY") & ~kind.isin("STRING", "BOOLEAN"), F.try_variant_get(v, "$", "double").cast("bigint"))
    text = F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
    # Zoned text carries its own offset, so the session zone never enters.
    rfc = F.when(
        text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"),
        F.unix_seconds(F.try_to_timestamp(text)),
    )
    day = F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), F.unix_date(text.try_cast("date")).cast("bigint") * SECONDS_PER_DAY)
    return F.coalesce(number, text.try_cast("bigint"), rfc, day, head)


# --- small lookups ------------------------------------------------------------------------

def attr_code(attr) -> Column:
    attr = as_col(attr)
    return reduce(lambda acc, kv: acc.when(attr == kv[0], kv[1]), ATTR_CODES.items(), F).otherwise(0)


def role_count(roles) -> Column:
    roles = as_col(roles)
    return F.when(roles.isNull(), 0).otherwise(F.size(roles))


def known_roles(roles) -> Column:
    trimmed = F.transform(as_col(roles), lambda r: F.trim(r))
    return F.array_sort(F.filter(trimmed, lambda r: r.isin(*KNOWN_ROLES)))


def guarded_ratio(numerator, denominator) -> Column:
    d = as_col(denominator)
    return F.when(d > 0, as_col(numerator) / d)


def int_key(c) -> Column:
    return F.trim(as_col(c)).try_cast("int")


# --- seeded ordering ----------------------------------------------------------------------

# Modulus and multipliers of the integer mixing below.
MIX_MODULUS = 2147483647
MIX_FACTORS = (48271, 16807, 69621)


def sample_base(seed: int, contest, slot) -> Column:
    """The part of ``sample_key`` that does not depend on the item."""
    a, b, _ = MIX_FACTORS
    contest, slot = as_col(contest).cast("bigint"), as_col(slot).cast("bigint")
    return F.pmod(contest, F.lit(MIX_MODULUS).cast("bigint")) * a + slot * b + seed


def sample_mix(base, item) -> Column:
    item = as_col(item).cast("bigint")
    x = (base + item * MIX_FACTORS[2]) % MIX_MODULUS
    return (x * x + item) % MIX_MODULUS


def sample_key(seed: int, contest, slot, item) -> Column:
    """Pseudo-random integer from (seed, contest, slot, item).

    Every intermediate stays below 2^63, so any engine with 64-bit integers gives the same
    order, and the same rows are sampled again whatever the partitioning.
    """
    return sample_mix(sample_base(seed, contest, slot), item)


def unit_interval(key) -> Column:
    return as_col(key) / F.lit(float(MIX_MODULUS))
