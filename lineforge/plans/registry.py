"""Collects every registered query and oracle."""

from __future__ import annotations

from . import catalog, catalog_models, catalog_reports  # noqa: F401  (register on import)


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return {k: v for k, v in catalog.ORACLES.items() if k in catalog.QUERIES}
