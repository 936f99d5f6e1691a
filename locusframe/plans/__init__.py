"""Named queries over the driver tables. Importing the package registers all of them."""

from locusframe.plans import read_queries, region_queries, table_queries, variant_queries  # noqa: F401
from locusframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
