"""Named queries of the subpackage and their SQL, gathered from one module per problem."""

from __future__ import annotations

from importlib import import_module

MODULES = ("queries_consensus", "queries_quota", "queries_subjects", "queries_sizes", "queries_abuse")

QUERIES: dict = {}
SQL: dict = {}
for _name in MODULES:
    _module = import_module(f".{_name}", __package__)
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
