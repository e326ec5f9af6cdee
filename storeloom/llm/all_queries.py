"""All registered queries of the subpackage."""

from __future__ import annotations

from storeloom.llm import queries_audits, queries_native, queries_text  # noqa: F401
from storeloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
