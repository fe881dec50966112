"""Folds of documents by the digest of their id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def held_out(doc_id: str, folds: int, which: int) -> Column:
    """Whether the row is in the fold kept from learning; a row without an id is not."""
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))
