"""Named queries over the engine and their SQL twins."""

from . import agreement, annotate, documents, exports, reconcile, runs, selection, sources, updates  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
