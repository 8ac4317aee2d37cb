"""Every query of the library outside ``llm``, with its DuckDB SQL."""

from __future__ import annotations

from millrace.plans import corpus, domain, evidence, imports, inventory, registrations, reports  # noqa: F401  they register their queries
from millrace.plans.registry import QUERIES, SQL

FLAGSHIP = "inventory_latest_status"


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
