"""All queries of the library by name, with their DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = ("market_plans", "table_plans", "clean_plans", "join_plans", "statement_plans", "bond_plans", "port_plans", "nowcast_plans", "text_plans", "property_plans", "live_plans", "investor_plans", "overlay_plans")


def _all(which: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"{__package__}.{name}"), which)
    return out


def queries() -> dict:
    return _all("Q")


def oracle_sql() -> dict[str, str]:
    return {name: statement for name, statement in _all("S").items() if statement}
