"""Whole jobs and the queries registered on the star-schema tables."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every module of this package, so that its queries are registered."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
