"""Registered queries: every operator of the library run over the given tables, with its SQL."""

from importlib import import_module

MODULES = ("scalars", "joins", "aggregates", "windows", "sets", "rasters", "images", "tables", "composites")


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
