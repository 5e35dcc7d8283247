"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def sha256_hex(c: ColumnOrName) -> Column:
    """Lower-case SHA-256 hex digest; NULL in gives NULL out."""
    return F.sha2(_c(c).cast("string"), 256)


def hash_key(*parts: ColumnOrName, sep: str = "|") -> Column:
    """Digest of the ``sep``-joined parts. NULL parts are skipped by the join
    (so two different part layouts can collide; kept for key compatibility)."""
    return F.sha2(F.concat_ws(sep, *[_c(p).cast("string") for p in parts]), 256)
