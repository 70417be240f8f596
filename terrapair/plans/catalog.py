"""Every query of the library with its SQL oracle."""

from terrapair.plans import baseline_queries, extract_queries, match_queries, polygon_queries, step_queries, trend_queries  # noqa: F401  they register
from terrapair.plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = "unadjusted_baseline"
__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
