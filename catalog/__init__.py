"""Queries over the test tables, one per operator, with the SQL that checks each."""

from __future__ import annotations

import importlib

MODULES = ("tables", "aggregates", "sets_and_order", "sampling", "contracts", "preprocessing", "drift", "performance",
           "models", "closed_form", "explanations")


def everything():
    from catalog.registry import QUERIES, SQL

    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return QUERIES, SQL
