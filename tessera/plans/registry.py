"""All named queries of the engine, gathered from the plan modules."""

from __future__ import annotations

from tessera.plans import advanced, audits, extended, pipelines, ranking, relational, retrieval, textual


def _modules():
    return [relational, textual, retrieval, ranking, pipelines, extended, advanced, audits]


def queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _modules() for k, s in m.ORACLES.items()}
