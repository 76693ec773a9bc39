"""Registered queries and their DuckDB oracles, gathered from the plan modules."""

from __future__ import annotations

from quillstack.plans import archive, evidence, found, linked, pieces, stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (archive, linked, pieces, found, stored, evidence):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
