"""Every query of the engine by name, with the DuckDB SQL it must agree with where SQL can express it."""

from __future__ import annotations

from spanloom.plans import aggregation, contracts, extras, incremental, relational, scoring, search, sets, structured, text, windows
from spanloom.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregation", "contracts", "extras", "incremental", "relational", "scoring", "search", "sets", "structured", "text", "windows"]
