"""Queries over the given tables."""

from importlib import import_module

MODULES = ["texts", "samples", "features", "pages", "progress", "models", "feeds", "sources"]


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"kanaat.plans.{name}")
