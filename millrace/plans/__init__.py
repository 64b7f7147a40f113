"""Named queries over the test tables, each beside the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

MODULES = ("recap", "lines", "messages", "aggregates", "windows", "joins", "changes", "outputs")


def load() -> None:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
