"""Named queries (one per operator of the inventory) and their oracles."""

from loomgraph.plans import q_build, q_chunks, q_condense, q_eval, q_graph, q_groups, q_sparse, q_text, q_vectors  # noqa: F401
from loomgraph.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
