"""The core's queries by name and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "functions.text_metrics", "functions.language", "functions.clean", "functions.entities", "functions.links", "functions.facts", "functions.markup", "functions.metadata", "operators.quality", "operators.confidence", "operators.dedup", "operators.similar", "operators.dataset", "operators.ops", "operators.health", "operators.store", "operators.tiers", "operators.build", "streaming.state",
)


def _all(attr: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"millrace.{m}"), attr)
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE")
