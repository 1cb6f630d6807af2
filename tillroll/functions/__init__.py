"""Column-level helpers built only from JVM-side Spark SQL functions."""

from tillroll.functions.text import (  # noqa: F401
    parse_article_ids,
    parse_items,
    percent_text,
    safe_token,
    strip_prefixes,
    title_case,
    zfill,
)
from tillroll.functions.arrays import itemset_key, pad_sequence  # noqa: F401
