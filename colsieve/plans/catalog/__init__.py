"""Named queries over the supplied tables, each with the SQL that checks it."""

from colsieve.plans.catalog.common import CATALOG
from colsieve.plans.catalog import tables, profiles, similarities, graphs, records, models  # noqa: F401

__all__ = ["CATALOG"]
