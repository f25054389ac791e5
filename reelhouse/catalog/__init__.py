"""Every query of the package with its comparison SQL."""

from __future__ import annotations

import importlib
import pkgutil


def load_catalog():
    from reelhouse.catalog.registry import CATALOG

    for module in pkgutil.iter_modules(__path__):
        if module.name.startswith("queries_"):
            importlib.import_module(f"{__name__}.{module.name}")
    return CATALOG
