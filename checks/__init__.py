"""Queries over the supplied tables, one per operator, with DuckDB oracles."""

import importlib

MODULES = [importlib.import_module(f"checks.{m}") for m in ("expressions", "relations", "pages", "files")]
