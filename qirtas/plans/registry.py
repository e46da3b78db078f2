"""Every query of the core, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from qirtas.plans import corpus_queries, graph_queries, layer_queries, orphans, text_queries
from qirtas.plans.register import Query

_PARTS = text_queries.register, graph_queries.register, layer_queries.register, corpus_queries.register


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {"p4_found": orphans.found, "p4_monthly": orphans.monthly}
    for part in _PARTS:
        out |= part.queries
    return out


def oracle_sql() -> dict[str, str]:
    out = {"p4_found": orphans.FOUND_ORACLE, "p4_monthly": orphans.MONTHLY_ORACLE}
    for part in _PARTS:
        out |= part.sql
    return out
