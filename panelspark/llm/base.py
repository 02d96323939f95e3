"""What the text operators share: written intermediate tables and small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelspark.session import stored

__all__ = ["stored", "utf8", "words_text"]


def words_text(c: str | Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))


def utf8(c: str | Column) -> Column:
    """A text, null as empty, as its UTF-8 bytes."""
    return words_text(c).cast("binary")
