"""Links: code repositories and hosts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed
from .text import as_col


def repo_owner(c) -> Column:
    """Owner in the first repository link of a text, null if there is none."""
    return F.nullif(F.regexp_extract(as_col(c), fixed.REPO_PATTERN, 1), F.lit(""))


def repo_name(c) -> Column:
    return F.nullif(F.regexp_extract(as_col(c), fixed.REPO_PATTERN, 2), F.lit(""))


def repo_url(c) -> Column:
    """Plain https link of the first repository in a text; dots at the end go, ``.git`` stays."""
    link = F.concat(F.lit(fixed.REPO_URL), repo_owner(c), F.lit("/"), repo_name(c))
    return F.rtrim(link, F.lit("."))


def repo_key(c) -> Column:
    """Name under which repository numbers are kept: no closing punctuation, no ``.git``."""
    bare = F.rtrim(as_col(c), F.lit(fixed.REPO_TRAILING))
    return F.regexp_replace(bare, r"\.git\z", "")


def host(c) -> Column:
    """Lowered host of a url, null where there is none."""
    found = F.regexp_extract(as_col(c), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))
