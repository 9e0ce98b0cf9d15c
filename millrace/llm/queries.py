"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module
from pkgutil import iter_modules


def _all(attr: str) -> dict:
    package = import_module(__package__)
    out: dict = {}
    for m in sorted(m.name for m in iter_modules(package.__path__) if m.name[:1] == "p" and m.name[1:3].isdigit()):
        out |= getattr(import_module(f"{__package__}.{m}"), attr)
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE")
