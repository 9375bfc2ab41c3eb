"""Query registry: every module listed here has QUERIES and SQL."""

from __future__ import annotations

from movelane.plans import events, general, inventory, relational, streams, texts, upkeep

MODULES = [general, relational, texts, events, upkeep, inventory, streams]
FLAGSHIP = "v04_practice_group_trend"


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
