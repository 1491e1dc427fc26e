"""Imports every binding module, so that each registers its queries."""

from . import catalogs, consumers, details, jobs, logs, objects, refresh, stats, types  # noqa: F401
from .registry import CHECK_SQL, QUERIES  # noqa: F401
