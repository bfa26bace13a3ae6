"""Registered queries: every operator over the driver's tables, with its SQL where SQL can say it."""

from __future__ import annotations

import importlib

_MODULES = ("scalar", "realtime", "registry", "inventory", "schedule", "telemetry", "streams")


def all_queries() -> dict:
    return {k: v for name in _MODULES for k, v in importlib.import_module(f"{__name__}.{name}").QUERIES.items()}


def all_oracles() -> dict:
    return {k: v for name in _MODULES for k, v in importlib.import_module(f"{__name__}.{name}").ORACLES.items()}
