"""Named queries over a star-schema directory, each with the SQL that states its result."""

import importlib

from draftlake.registry.core import ORACLES, QUERIES

_MODULES = ["q_profiles", "q_drafts", "q_features", "q_decode", "q_joins", "q_streams", "q_store"]
for _m in _MODULES:
    importlib.import_module(f"draftlake.registry.{_m}")

__all__ = ["ORACLES", "QUERIES"]
