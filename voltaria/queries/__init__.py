"""Registered queries over the driver tables."""

from importlib import import_module

from voltaria.queries.registry import ORACLES, QUERIES

_MODULES = ("sources", "cleaning", "features", "spatial", "evaluation", "pricing", "monitoring", "reports", "learning", "streams")


def load_all() -> None:
    """Import every query module; importing registers its queries."""
    for name in _MODULES:
        import_module(f"voltaria.queries.{name}")


__all__ = ["ORACLES", "QUERIES", "load_all"]
