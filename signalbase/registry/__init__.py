"""Registered queries over the given tables, each with its SQL twin where one exists."""

from __future__ import annotations

from . import columns, dates, declared, flows, names, readers, streams, tables  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
