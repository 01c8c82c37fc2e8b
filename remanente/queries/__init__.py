"""Every operator as a named query over the given tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ["prepare", "lookup_queries", "accrual_queries", "primitives", "recon_queries"]


def load() -> None:
    """Import the query modules, which register themselves."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
