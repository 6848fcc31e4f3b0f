"""Named features and the inputs each of them needs.

A feature is a column over what its inputs provide for a candidate. The planner asks the registry which inputs the wanted
features use, and joins only those. Own features are registered the same way, and may bring an input of their own.

Inputs that ``plans.features`` provides, with the columns a feature finds:

* always: contest_id, slot, is_pick, side, acting_team, opp_team, item_id, label, team_picks_before, enemy_picks_before
* ``own_team``, ``opp_team``: the acting / opposing team's profile of the item, ``own`` and ``opp`` (games, shrunk_wr)
* ``synergy``, ``counter``: mean rate with allies, against enemies, ``syn`` and ``ctr``
* ``comfort``: ``n_actors`` of the acting roster, ``known_actors`` with a rate on the item, ``known_sum`` of these in millionths
* ``roster_threat``: mean best rate of the opposing roster
* ``meta``: ``attr`` and ``roles_n`` of the item; ``global``: its ``g_picks`` and ``g_rate``
* ``priors``: ``item_pick_rate``, ``item_wr``, ``item_popularity`` among the decisions
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import MILLION, millionths

Value = Callable[[object], Column]
Attach = Callable[[DataFrame, object], DataFrame]

# Share of each attribute in the fit score, longest slot, picks per side, games that make a threat.
FIT_INT, FIT_AGI, FIT_STR = 0.5, 0.3, 0.2
SLOT_SCALE, SIDE_PICKS, TEAM_THREAT_GAMES = 30.0, 5, 3


@dataclass(frozen=True)
class Feature:
    name: str
    needs: tuple[str, ...]
    value: Value


class FeatureRegistry:
    """Features by name, in order of registration, and the user's own inputs."""

    def __init__(self, other: FeatureRegistry | None = None):
        self.features: dict[str, Feature] = dict(other.features) if other else {}
        self.inputs: dict[str, Attach] = dict(other.inputs) if other else {}

    def register(self, name: str, value: Value, *needs: str, replace: bool = False) -> None:
        """Add a feature; ``value`` takes the feature tables and gives a column."""
        if name in self.features and not replace:
            raise ValueError(f"feature {name} is registered already")
        self.features[name] = Feature(name, needs, value)

    def feature(self, *needs: str):
        """Register the decorated function under its own name."""
        def wrap(fn: Value) -> Value:
            self.register(fn.__name__, fn, *needs)
            return fn
        return wrap

    def register_input(self, name: str, attach: Attach) -> None:
        """Add an input: ``attach(candidates, tables)`` adds columns, e.g. by a join on item_id, and keeps the rows."""
        self.inputs[name] = attach

    def chosen(self, names: list[str]) -> list[Feature]:
        unknown = [n for n in names if n not in self.features]
        if unknown:
            raise KeyError(f"unknown features: {', '.join(unknown)}")
        return [self.features[n] for n in names]

    def needs(self, names: list[str]) -> set[str]:
        return {i for f in self.chosen(names) for i in f.needs}


def flag(cond: Column) -> Column:
    return F.when(cond, 1.0).otherwise(0.0)


DEFAULT = FeatureRegistry()
_own_rate = lambda: F.coalesce("g_rate", F.lit(0.5))
_attr = lambda: F.coalesce("attr", F.lit(0))


def _is(code: int) -> Column:
    """The item's attribute; 4 stands for all of them."""
    return flag((_attr() == code) | (_attr() == 4))


def _comfort(ft) -> Column:
    """Mean rate of the roster on the item; actors without one count with the item's own rate."""
    total = F.col("known_sum") + (F.col("n_actors") - F.col("known_actors")) * millionths(_own_rate())
    mean = F.when(F.col("n_actors") > 0, total / F.col("n_actors") / MILLION).otherwise(0.5)
    known = ft.actors_known
    return mean if known is True else _own_rate() if known is False else F.when(known, mean).otherwise(_own_rate())


_before = lambda: (F.col("team_picks_before"), F.col("enemy_picks_before"))

for _name, _needs, _value in [
    ("team_picks", ("own_team", "global"), lambda ft: F.coalesce("own.games", "g_picks", F.lit(0))),
    ("team_wr_shrunk", ("own_team", "global"), lambda ft: F.coalesce("own.shrunk_wr", "g_rate", F.lit(0.5))),
    ("mean_syn_with_allies", ("synergy",), lambda ft: F.coalesce("syn", F.lit(0.5))),
    ("mean_counter_vs_enemies", ("counter",), lambda ft: F.coalesce("ctr", F.lit(0.5))),
    ("hero_meta_primary_attr", ("meta",), lambda ft: _attr()),
    ("hero_meta_role_count", ("meta",), lambda ft: F.coalesce("roles_n", F.lit(0))),
    ("player_comfort", ("comfort", "global"), _comfort),
    ("star_threat", ("opp_team",), lambda ft: F.when(F.col("opp.games") >= TEAM_THREAT_GAMES, F.col("opp.shrunk_wr")).otherwise(0.0)),
    ("hero_pick_rate", ("priors",), lambda ft: F.coalesce(F.col("item_pick_rate"), F.lit(2.0) / (ft.total_picks.scalar() + 4.0))),
    ("hero_wr", ("priors",), lambda ft: F.coalesce("item_wr", F.lit(0.5))),
    ("hero_popularity", ("priors",), lambda ft: F.coalesce("item_popularity", F.lit(0.0))),
    ("attr_is_str", ("meta",), lambda ft: _is(1)),
    ("attr_is_agi", ("meta",), lambda ft: _is(2)),
    ("attr_is_int", ("meta",), lambda ft: _is(3)),
    ("attr_fit_score", ("meta",), lambda ft: _before()[0] * F.greatest(_is(3) * FIT_INT, _is(2) * FIT_AGI, _is(1) * FIT_STR)),
    ("draft_slot_norm", (), lambda ft: F.col("slot") / SLOT_SCALE),
    ("is_pick_phase", (), lambda ft: flag(F.coalesce("is_pick", F.lit(True)))),
    ("team_picks_before", (), lambda ft: _before()[0]),
    ("enemy_picks_before", (), lambda ft: _before()[1]),
    ("is_first_pick", (), lambda ft: flag(_before()[0] == 0)),
    ("is_last_pick", (), lambda ft: flag(_before()[0] == SIDE_PICKS - 1)),
    ("is_counter_phase", (), lambda ft: flag(_before()[1] > _before()[0])),
    ("remaining_team_picks", (), lambda ft: F.greatest(F.least(SIDE_PICKS - _before()[0], F.lit(SIDE_PICKS)), F.lit(0))),
    ("draft_progress", (), lambda ft: F.greatest(F.least((_before()[0] + _before()[1]) / 10.0, F.lit(1.0)), F.lit(0.0))),
]:
    DEFAULT.register(_name, _value, *_needs)

# The training variant of the opponent threat: of the roster's best items instead of the team on this one.
ROSTER = FeatureRegistry(DEFAULT)
ROSTER.register("star_threat", lambda ft: F.col("roster_threat"), "roster_threat", replace=True)
