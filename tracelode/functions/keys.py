"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(parts: tuple[str | Column, ...]) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def surrogate_key(*parts: str | Column) -> Column:
    """First 32 hex digits of the sha256 of the parts joined with ``|``; NULL counts as ''."""
    return F.substring(F.sha2(_joined(parts), 256), 1, 32)


def merge_key(*parts: str | Column) -> Column:
    """The md5 form of the same key, used by the merge path."""
    return F.md5(_joined(parts))
