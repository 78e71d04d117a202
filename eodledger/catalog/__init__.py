"""Queries over the given tables, each next to the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("filters", "windows", "joining", "aggregates", "files", "jobs", "report_queries")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"eodledger.catalog.{name}")
