"""All named queries. Importing the modules registers them."""

from touchline.plans import analytics, base, clean, learners, statistics  # noqa: F401
from touchline.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
