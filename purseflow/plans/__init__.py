"""The reports, grouped by subject. Importing this package registers all of them."""

import importlib

MODULES = ["aggregates", "relations", "quality", "warehouse", "batch", "streams"]

for _name in MODULES:
    importlib.import_module(f"{__name__}.{_name}")
