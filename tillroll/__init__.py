"""tillroll: market-basket analytics written as Spark DataFrame jobs.

Raw purchase lines -> baskets -> frequent itemsets (level-wise, FP-growth,
vertical tid-lists) -> association rules, plus basket variants, profiling,
method comparison and next-item ranking over score tables.
"""

__version__ = "0.1.0"
