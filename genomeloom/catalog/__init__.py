"""Bindings of the operators to the driver tables, each with its SQL twin where one exists."""

from __future__ import annotations

from importlib import import_module

from .registry import REGISTRY, Entry

AREAS = (
    "sequences",
    "files",
    "features",
    "hits",
    "reconcile",
    "bands",
    "intake",
    "ledger",
    "scoring",
    "texts",
    "variants",
    "streams",
)


def load() -> dict[str, Entry]:
    for area in AREAS:
        import_module(f"{__name__}.{area}")
    return dict(REGISTRY)
