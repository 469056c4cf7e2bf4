"""All registered queries of the library itself."""

from __future__ import annotations

from tidemark.plans import cdc, entities, marts
from tidemark.plans.catalog import ORACLES, QUERIES

MODULES = (marts, cdc, entities)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
