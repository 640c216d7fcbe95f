"""Registered queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("evaluation", "recordings", "rules", "values", "datasets", "catalogue", "live")


def load():
    """All registered queries and oracles."""
    from runlens.plans import registry

    for name in MODULES:
        importlib.import_module(f"runlens.plans.{name}")
    return registry.QUERIES, registry.ORACLES
