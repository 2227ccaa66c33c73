"""All registered queries (importing the catalog modules registers them)."""

from adlake.plans import catalog, catalog_normalize, catalog_semantic, catalog_writes  # noqa: F401
from adlake.plans.catalog import QUERIES

__all__ = ["QUERIES"]
