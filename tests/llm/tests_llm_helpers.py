"""Shared by the tests of this folder."""

from __future__ import annotations


def as_rows(rows):
    """Rows as tuples in a fixed order, NULLs included."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))
