"""Operators for preparing text corpora at scale. Importing this package registers their queries."""

import importlib
import pkgutil

from .registry import CHECKS, QUERIES  # noqa: F401

for _found in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("op")):
    importlib.import_module(f"{__name__}.{_found}")
