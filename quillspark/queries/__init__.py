"""Queries of the general operators, and the SQL that gives the same rows."""

from . import blocks, chunks, folds, merging, more, text  # noqa: F401
from ._base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
