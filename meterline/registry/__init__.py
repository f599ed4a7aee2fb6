"""All checked queries: import the modules that register them."""

from . import columns, learning, marts, reports, sampling, sources, summaries  # noqa: F401
from .core import CHECK_SQL, QUERIES

__all__ = ["CHECK_SQL", "QUERIES"]
