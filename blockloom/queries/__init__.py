"""Every operator as a query over the given tables, with its SQL twin."""

from __future__ import annotations

import importlib

from blockloom.queries.registry import ORACLES, QUERIES

for _area in ("scans", "rows", "vocab", "packing", "instruct", "sampling", "stats", "collate", "requests", "results", "vectors", "jobs"):
    importlib.import_module(f"blockloom.queries.{_area}")

__all__ = ["ORACLES", "QUERIES"]
