"""Queries over the driver tables, one per operator, with their SQL."""

from importlib import import_module

from .base import QUERIES, SQL

for _module in ("panel", "ingest", "rollup", "network", "views", "posts", "scalars"):
    import_module(f"{__name__}.{_module}")

__all__ = ["QUERIES", "SQL"]
