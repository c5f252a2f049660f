"""The catalogue of queries: operators applied to the driver's tables."""

from __future__ import annotations

from importlib import import_module

PLANS = ("scalars", "relational", "entity", "stateful", "evaluation", "ingest", "collecting", "evaluating", "ledgers", "merges", "reporting", "requesting")


def load() -> tuple[dict, dict]:
    """All queries and their SQL."""
    from .registry import ORACLES, QUERIES

    for name in PLANS:
        import_module(f"{__name__}.{name}")
    return QUERIES, ORACLES
