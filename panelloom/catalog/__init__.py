"""Check queries over the test tables."""

from importlib import import_module

MODULES = [
    "windows_q",
    "scalars_q",
    "merges_q",
    "stats_q",
    "plans_q",
]


def load():
    """Import every query module and return the filled registry."""
    for name in MODULES:
        import_module(f"panelloom.catalog.{name}")
    return import_module("panelloom.catalog.registry")
