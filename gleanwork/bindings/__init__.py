"""Operators bound to the driver tables, each with its SQL counterpart."""

from __future__ import annotations

import importlib

from gleanwork.bindings.registry import ORACLE, QUERIES

MODULES = ("files", "sampling", "attempts", "quota", "evaluation", "review", "gates", "publication")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"gleanwork.bindings.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
