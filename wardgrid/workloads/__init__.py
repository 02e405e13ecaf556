"""Queries over the shared test tables, with the SQL each must agree with."""

from . import ingest, marts, transforms  # noqa: F401  (imported for registration)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
