"""Registered queries and their expected SQL."""

from importlib import import_module

from matchloom.catalog.registry import EXPECTED, QUERIES

for _name in ("model_queries", "quality_queries", "write_queries", "lifecycle_queries", "history_queries",
              "declared_queries", "page_queries", "stream_queries"):
    import_module(f"matchloom.catalog.{_name}")

__all__ = ["EXPECTED", "QUERIES"]
