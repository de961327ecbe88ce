"""All registered queries of the package."""

from . import q_aggregates, q_evidence, q_exports, q_gates, q_identity, q_more, q_pairs, q_records, q_sources, q_trees
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "q_aggregates", "q_evidence", "q_exports", "q_gates", "q_identity", "q_more", "q_pairs", "q_records", "q_sources", "q_trees"]
