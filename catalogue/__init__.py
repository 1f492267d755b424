"""The registered queries, grouped as in the coverage table of the README."""

from __future__ import annotations

import importlib

MODULES = ("sources", "columns", "quality", "text", "sentiment", "warehouse", "distributions", "insights", "streaming")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"catalogue.{name}")


load()
