"""Queries over the given tables, each with an SQL oracle where SQL can express it."""

from __future__ import annotations

from importlib import import_module

from clickloom.registry.base import ORACLES, QUERIES

MODULES = ["scans", "app", "metrics", "text"]


def _load() -> None:
    for name in MODULES:
        import_module(f"clickloom.registry.{name}")


def queries():
    _load()
    return dict(QUERIES)


def oracles():
    _load()
    return dict(ORACLES)
