"""Registered queries, by subject."""

from loomlog.catalog import entities, lines, measures, tags, web  # noqa: F401
from loomlog.catalog import learning  # noqa: F401  (reuses statements of the others)
from loomlog.catalog import details  # noqa: F401
from loomlog.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
