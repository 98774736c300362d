"""All named queries."""

from larder.plans import (  # noqa: F401
    calendar_queries,
    history_queries,
    loyalty_queries,
    quality_queries,
    sales_queries,
    store_queries,
)
from larder.plans.registry import QUERIES

__all__ = ["QUERIES"]
