"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the sequence model the recommender tables follow.
MAX_SEQ_LEN = 20
PADDING_ID = 0


def itemset_key(c: Column | str) -> Column:
    """Items joined by one blank (items are sorted first by the caller)."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, " ")


def pad_sequence(c: Column | str, length: int = MAX_SEQ_LEN, pad: int = PADDING_ID) -> Column:
    """Keep the last ``length`` values and pad on the right with ``pad``."""
    c = F.col(c) if isinstance(c, str) else c
    kept = F.slice(c, F.greatest(F.size(c) - (length - 1), F.lit(1)), length)
    padding = F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(kept), F.lit(0)))
    return F.concat(kept, padding)
