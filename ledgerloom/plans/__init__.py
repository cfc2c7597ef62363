"""Queries by name and the SQL they are held against."""

from __future__ import annotations

import importlib

MODULES = ("parliament", "published", "resolution", "rebuild", "reading")


def _gather(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"ledgerloom.plans.{name}"), attribute)
    return out


def all_queries() -> dict:
    """name -> callable(spark, folder)."""
    return _gather("QUERIES")


def all_oracles() -> dict:
    """name -> SQL."""
    return _gather("ORACLES")
