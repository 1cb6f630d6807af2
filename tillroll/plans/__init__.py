"""Registered queries (one per operator of the inventory) and their oracles."""

from tillroll.plans import basket_queries, io_queries, mining_queries, prep_queries, sequence_queries  # noqa: F401
from tillroll.plans.registry import ORACLE, QUERIES  # noqa: F401
