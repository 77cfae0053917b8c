"""Import every recipe module so that the registry is complete."""

from loadworks.plans import (apply_queries, audit_queries, corpus_queries,  # noqa: F401
                             file_queries, matching_queries, scd_queries,
                             shaping_queries)
from loadworks.plans.registry import ORACLE, QUERIES  # noqa: F401
