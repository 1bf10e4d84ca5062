"""All queries over the ocean operators, by name, with the SQL that must give the same rows."""

from importlib import import_module

from .common import Registry

REGISTRY = Registry()
for _name in ("gridding", "catalog", "boxes", "matching", "fields", "samples", "scans", "products", "streaming"):
    _part = import_module(f".{_name}", __name__).R
    REGISTRY.queries.update(_part.queries)
    REGISTRY.sql.update(_part.sql)
