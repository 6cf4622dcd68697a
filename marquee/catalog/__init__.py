"""Checks by area; importing a module registers its queries."""

from importlib import import_module

MODULES = ["cleaning", "sources", "joining", "analytics", "texts", "scoring", "learning"]


def load_all() -> tuple[dict, dict]:
    """(queries, oracles) with every module registered."""
    for name in MODULES:
        import_module(f"marquee.catalog.{name}")
    registry = import_module("marquee.catalog.registry")
    return registry.QUERIES, registry.ORACLES
