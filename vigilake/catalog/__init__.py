"""Registered queries and, where SQL can say the same, the DuckDB text they are checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ("views", "adhoc", "detection", "hunting", "normalise", "triage", "live", "storage")


def registry() -> dict:
    """name -> (callable(spark, sf_dir), sql or None)"""
    found: dict = {}
    for name in MODULES:
        found.update(import_module(f"vigilake.catalog.{name}").QUERIES)
    return found
