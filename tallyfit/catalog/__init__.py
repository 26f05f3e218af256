"""All registered queries with the SQL that gives the same rows."""

from . import (  # noqa: F401
    feature_queries,
    metric_queries,
    model_queries,
    row_queries,
    text_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
