"""Operators of a training-data pipeline and their queries; nothing outside imports this folder."""

from __future__ import annotations

import importlib

MODULES = (
    "bpe",
    "longest_factor",
    "near_dup",
    "license_rules",
    "quotes",
    "decontaminate",
    "importance",
    "sharding",
    "token_budget",
    "toxicity",
    "token_files",
    "prefix_trie",
    "hard_negatives",
)


def load():
    """All queries of this folder and their SQL twins."""
    from runlens.llm import registry

    for name in MODULES:
        importlib.import_module(f"runlens.llm.{name}")
    return registry.QUERIES, registry.ORACLES
