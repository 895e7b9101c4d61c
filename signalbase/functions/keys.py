"""Deduplication keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .links import host
from .text import as_col, normalize_name, py_strip


def hash_key(*cols) -> Column:
    """SHA-256 of the parts joined by ``_``, trimmed and lowered. Null parts count as empty."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.lower(py_strip(F.concat_ws("_", *parts))), 256)


def content_hash(entity, title, url) -> Column:
    """SHA-256 of canonical entity, normalised title and source host."""
    parts = [as_col(entity), normalize_name(title), host(url)]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)
