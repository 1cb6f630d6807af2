"""Line dedup over content-defined chunks of lines (DataFrame functions only).

Every line is hashed; a rolling hash covers ``min_lines`` (two) neighbouring
line hashes.  Chunk boundaries are where the rolling hash passes from values
that occur once to values that occur again, so a boundary depends on the lines
around it and on nothing before them: a passage that is shifted by inserted
lines is cut at the same places, and a passage of only two lines has a chunk of
its own.  Blank lines carry no hash: a passage is the same with or without
them, and those inside a removed chunk go with it.

Rolling hashes are counted with map-side combining.  For those that occur more
than once the lines they cover are fetched and grouped by their bytes; of equal
ones the first (by doc_id, then place) stays, and the lines that later ones
cover are removed.  Each line's first occurrence in the table always stays, as
no earlier lines equal it.  Lines that a third of all documents share collapse in
the map-side aggregation, and their occurrences sit on the left of a join that
AQE splits.

Defined cases: null text is empty; an empty text is one (blank) line; a text of
fewer than ``min_lines`` lines that are not blank loses nothing; removing all
lines leaves the empty text; a line that repeats itself again and again ends up
once; null doc_ids order first; rows that repeat id and text are one document
with one result each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, text_or_empty
from tillroll.session import cut_lineage

MIN_LINES = 2
KEY = ["doc_id", "h", "len"]
NOT_BLANK = r"[^\x20\x09-\x0D]"


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, h, len, text): one row per row."""
    text = text_or_empty(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                       F.octet_length(text).alias("len"), text.alias("text"))


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, len, solid, hashes): the lines that are not blank, as
    (pos, line), and the hash of each."""
    numbered = F.transform(_lines(), lambda line, i: F.struct(i.alias("pos"), line.alias("line")))
    solid = _documents(docs).select(*KEY, F.filter(numbered, lambda z: z["line"].rlike(NOT_BLANK)).alias("solid"))
    return solid.withColumn("hashes", F.transform("solid", lambda z: F.xxhash64(z["line"])))


def _each_run(min_lines: int, make) -> Column:
    """``make(i)`` for the number (from 1) of every line that begins a run."""
    last = F.size("hashes") - (min_lines - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), make))


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, h, len, a, b): first and last line number of every
    ``min_lines`` lines that occurred before, a written table."""
    hashed = _hashed(docs)

    def rolling(i: Column) -> Column:
        return F.xxhash64(F.slice("hashes", i, min_lines))

    def run(i: Column) -> Column:
        lines = F.transform(F.slice("solid", i, min_lines), lambda z: z["line"])
        return F.struct(rolling(i).alias("fp"), F.get("solid", i - 1)["pos"].alias("a"),
                        F.get("solid", i + (min_lines - 2))["pos"].alias("b"), F.array_join(lines, "\n").alias("body"))

    again = cut_lineage(hashed.select(F.explode(_each_run(min_lines, rolling)).alias("fp"))
                        .groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp"))
    # a row carries its own lines only, never the whole text
    some = cut_lineage(hashed.select(*KEY, F.inline(_each_run(min_lines, run)))
                       .join(broadcast_checked(again), "fp", "left_semi"))
    # equal bytes, not just equal hashes
    first = cut_lineage(some.groupBy("fp", "body").agg(F.min(F.struct(*KEY, "a")).alias("first")))
    return cut_lineage(some.join(first, ["fp", "body"])
                       .filter(~F.struct(*KEY, "a").eqNullSafe(F.col("first"))).select(*KEY, "a", "b").distinct())


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(doc_id, n_lines, removed_chunks, removed_lines, text): one row per row,
    the text without the repeated chunks."""
    gone = repeated_runs(docs, min_lines).groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("a", "b"))).alias("gone"))  # at most the lines of one text
    gone = cut_lineage(gone.withColumnsRenamed({"doc_id": "g_id", "h": "g_h", "len": "g_len"}))
    g = broadcast_checked(gone, limit=200_000)  # rows with an array each
    base = _documents(docs)
    joined = base.join(g, base["doc_id"].eqNullSafe(g["g_id"]) & (base["h"] == g["g_h"])
                       & (base["len"] == g["g_len"]), "left")
    # runs that overlap are one chunk; what stays is what lies between two chunks, and after the last
    after = F.transform("gone", lambda c, i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(F.get("gone", i - 1)["b"] + 1).alias("a"), c["a"].alias("b")))
    split = (joined.withColumn("lines", _lines())
             .withColumn("stay", F.filter(after, lambda z: (z["a"] <= z["b"])))
             .withColumn("last", F.element_at("gone", -1)["b"] + 1))
    kept = F.concat(F.flatten(F.transform("stay", lambda z: F.slice(F.col("lines"), z["a"] + 1, z["b"] - z["a"]))),
                    F.slice("lines", F.col("last") + 1, F.size("lines")))
    lost = F.col("last") - F.aggregate("stay", F.lit(0), lambda s, z: s + z["b"] - z["a"])
    return split.select(
        "doc_id", F.size("lines").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("stay")).alias("removed_chunks"),
        F.when(F.col("gone").isNull(), 0).otherwise(lost).alias("removed_lines"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
