"""Text expressions.  Each returns a ``Column`` and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values that results depend on.
ARTICLE_ID_WIDTH = 10
UNKNOWN_TOKEN = "unknown"
READABLE_PREFIXES = ["product_group_", "garment_group_", "section_", "outfit_"]


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c: ColumnLike, width: int = ARTICLE_ID_WIDTH) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole.

    ``lpad`` alone would truncate values longer than ``width``.
    """
    c = _col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def python_strip(c: ColumnLike) -> Column:
    """Strip leading and trailing whitespace of any kind (not only blanks)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def safe_token(c: ColumnLike) -> Column:
    """trim, lower, runs of ``[^a-z0-9]`` -> ``_``, trim ``_``; empty -> ``unknown``."""
    lowered = F.lower(python_strip(c))
    replaced = F.regexp_replace(lowered, "[^a-z0-9]+", "_")
    trimmed = F.btrim(replaced, F.lit("_"))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(UNKNOWN_TOKEN))


def parse_items(c: ColumnLike, pad_width: int | None = ARTICLE_ID_WIDTH) -> Column:
    """Parse ``a b c``, ``[a, b]`` or ``['a','b']`` into an array of ids.

    Outer brackets are stripped; a comma anywhere switches to comma splitting
    (pieces blank after trimming are dropped *before* quotes are removed, so
    ``''`` survives as an empty id); otherwise whitespace splitting.  Every id
    is zero-padded to ``pad_width`` unless it is ``None``.  Null -> empty.
    """
    c = _col(c)
    cleaned = F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", "")
    by_comma = F.transform(
        F.filter(F.split(cleaned, ","), lambda x: python_strip(x) != ""),
        lambda x: F.regexp_replace(python_strip(x), "^['\"]+|['\"]+$", ""),
    )
    by_space = F.filter(F.split(cleaned, r"\s+"), lambda x: x != "")
    items = F.when(cleaned.contains(","), by_comma).otherwise(by_space)
    if pad_width is not None:
        items = F.transform(items, lambda x: zfill(x, pad_width))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(items)


def parse_article_ids(c: ColumnLike) -> Column:
    """Split typed ids on commas and any whitespace, dropping empty pieces."""
    return F.filter(F.split(_col(c), r"[,\s]+"), lambda x: x != "")


def title_case(c: ColumnLike) -> Column:
    """Python ``str.title``: a word starts after any non-letter.

    ``initcap`` only starts words after blanks, so split into letter runs and
    other runs and capitalise each letter run.
    """
    pieces = F.regexp_extract_all(_col(c), F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(pieces, lambda x: F.initcap(x)), "")


def strip_prefixes(c: ColumnLike, prefixes: list[str] = READABLE_PREFIXES) -> Column:
    """Drop the first matching known prefix (at most one)."""
    c = _col(c)
    out = c
    for prefix in reversed(prefixes):
        out = F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(out)
    return out


def readable_token(c: ColumnLike) -> Column:
    """Category token without its prefix, ``_`` -> blank, title case."""
    return title_case(F.regexp_replace(strip_prefixes(c), "_", " "))


def percent_text(c: ColumnLike) -> Column:
    """``0.1234`` -> ``12.34%``; null -> ``N/A``."""
    c = _col(c)
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f%%", c * 100))
