"""All queries that don't need the ``llm`` subpackage."""

from __future__ import annotations

from vestigo.plans import data_problems, derivation_queries, evaluation_queries, evidence_queries, preparation_queries, relational_queries, retrieval_queries
from vestigo.registry import Registry


def core_registry() -> Registry:
    found = Registry()
    for module in (data_problems, retrieval_queries, relational_queries, preparation_queries, derivation_queries, evaluation_queries, evidence_queries):
        found.update(module.REGISTRY)
    return found
