"""All queries of this library outside the optional subpackage, and their SQL."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import quillon.plans as plans


def _modules():
    for info in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        if info.name != "registry":
            yield importlib.import_module(f"{plans.__name__}.{info.name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _modules() for name, f in getattr(m, "QUERIES", {}).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in getattr(m, "SQL", {}).items()}
