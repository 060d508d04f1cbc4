"""All named queries of the core and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("integrity", "diff", "facets", "rules", "metrics", "sampling", "merging", "vectors", "graph", "more", "taxonomy", "files")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f".{name}", __package__), attribute)
        if clash := out.keys() & part.keys():
            raise ValueError(f"queries named twice: {sorted(clash)}")
        out |= part
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
