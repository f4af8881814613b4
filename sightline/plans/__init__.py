"""Named queries over the given tables, with their checking SQL."""

from sightline.plans import evidence_queries, ledger_queries, visibility_queries  # noqa: F401
from sightline.plans.catalog import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
