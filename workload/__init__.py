"""Registered queries over the provided tables, each beside its independent SQL."""

from __future__ import annotations

from workload import analytics, documented, primitives, quality, storage, streams  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
