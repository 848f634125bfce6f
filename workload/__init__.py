"""Registered queries on the supplied tables."""

from __future__ import annotations


def _registered():
    from workload import catalogue_queries, check_queries, label_queries, registry, relational_queries, source_queries, vector_queries  # noqa: F401

    return registry


def all_queries():
    """Name to function (spark, folder) -> DataFrame."""
    return dict(_registered().QUERIES)


def all_oracles():
    """Name to DuckDB text."""
    return dict(_registered().ORACLES)
