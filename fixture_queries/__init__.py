"""Every operator bound to the driver's tables, each beside the SQL that must give the same rows."""

from fixture_queries import evaluation, features, files, graphs, models, profiles, searches, splits, students, validation
from fixture_queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
