"""Named queries over the driver's tables, each with its check SQL where SQL can say it."""

from __future__ import annotations

import importlib
import pkgutil

from sensorqc.catalog.registry import ORACLES, QUERIES


def load() -> None:
    for module in pkgutil.iter_modules(__path__):
        if module.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{module.name}")


__all__ = ["ORACLES", "QUERIES", "load"]
