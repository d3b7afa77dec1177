"""Named queries over the given tables, each with the SQL that must give the same rows."""

from tidemark.queries import baselines, promotions, ranking, splits, tuning  # noqa: F401
from tidemark.queries.catalog import QUERIES

__all__ = ["QUERIES"]
