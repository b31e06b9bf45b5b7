"""All queries of the library by name, with the SQL that each has to equal."""

from __future__ import annotations

from folia.plans import chain_queries, collection_queries, extraction_queries, graph_queries, metric_queries, planning_queries, repair_queries, resolution_queries, sampling_queries, search_queries, source_queries, summary_queries, table_queries, text_queries, tree_queries  # noqa: F401
from folia.plans.registry import ORACLE_SQL, QUERIES

FLAGSHIP = chain_queries.section_retrieval

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
