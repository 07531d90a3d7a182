"""All queries of the core, by name."""

from __future__ import annotations

from corpusloom.plans import corpus_queries, flow_queries, marker_queries, record_queries, repair_queries, rule_queries, source_queries, text_queries, training_queries

MODULES = [training_queries, text_queries, record_queries, corpus_queries, repair_queries, flow_queries, marker_queries, source_queries, rule_queries]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
