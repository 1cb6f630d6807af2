"""Exact dedup by deterministic block naming (DataFrame functions only).

Each normalised text is cut into fixed-size byte blocks.  The distinct blocks
are sorted and numbered, so a block's name is an integer that stands for its
bytes.  Then adjacent names are paired, the distinct pairs are sorted and
numbered, and so on until every text has one name.  Two texts get the same
``(level, name)`` exactly when their bytes are equal: names are given to
contents that were compared in full, never to hashes of them.

Scale: block contents are shuffled once, after map-side aggregation, so the
copies of a hot text collapse before the exchange.  Occurrences travel as
64-bit fingerprints and meet the name table on those; a fingerprint that
stands for several distinct blocks is found in the name table and its blocks
are named by a join on the bytes instead.  Every later level moves integers
only and halves the rows.  Hot names sit on the left of sort-merge joins, which
AQE splits.  Names come from written tables, so retried tasks see the same.

Defined cases: null text counts as empty; all empty texts are equal; a row
whose doc_id is null is a document like any other (it stays only if its group
has no other id); of repeated rows (same id, same text) one stays; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ascii_lower, broadcast_checked, drop_rows, text_or_empty
from tillroll.session import cut_lineage

BLOCK_BYTES = 4096
KEY = ["doc_id", "h", "len"]  # a document row; h and len part rows that share an id


def fingerprint64(block: Column) -> Column:
    return F.xxhash64(block)


def _row_key(norm: Column) -> list[Column]:
    return [F.xxhash64(norm).alias("h"), F.octet_length(norm).alias("len")]


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, h, len, sha at pos 0, pos, block): one row per block."""
    n = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    ascii_lower(text_or_empty(docs)).alias("t"))
    n = n.select("doc_id", *_row_key(n["t"]), F.sha2(n["t"], 256).alias("sha"), F.encode("t", "UTF-8").alias("b"))
    last = F.expr(f"greatest(0, cast((len - 1) div {block_bytes} as int))")
    pieces = F.transform(F.sequence(F.lit(0), last),
                         lambda i: F.substring(F.col("b"), i * block_bytes + 1, F.lit(block_bytes)))
    return n.select(*KEY, "sha", F.posexplode(pieces).alias("pos", "block")).withColumn(
        "sha", F.when(F.col("pos") == 0, F.col("sha")))


def _numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct rows, sorted inside their partition and numbered: an integer
    per content.  The caller writes it before anything joins it."""
    return df.sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())


def _name_blocks(docs: DataFrame, block_bytes: int, fp) -> DataFrame:
    """Level 0: (doc_id, h, len, pos, name, sha, copies)."""
    blocks = _blocks(docs, block_bytes).withColumn("fp", fp(F.col("block")))
    named = cut_lineage(_numbered(blocks.groupBy("fp", "block").agg(F.lit(0).alias("one")),
                                  ["block"], "name").select("fp", "name"))
    occ = blocks.groupBy(*KEY, "pos", "fp").agg(F.max("sha").alias("sha"), F.count(F.lit(1)).alias("copies"))
    shared = cut_lineage(named.groupBy("fp").count().filter("count > 1").select("fp"))
    n_shared = shared.count()
    if not n_shared:
        return occ.join(named, "fp").drop("fp")
    # fingerprints that stand for several blocks: those are named by their bytes
    by = broadcast_checked(shared, n_shared)
    some = blocks.join(by, "fp", "left_semi")
    own = cut_lineage(_numbered(some.select("block").distinct(), ["block"], "name")
                      .select("block", (-F.col("name") - 1).alias("name")))
    exact = (some.join(own, "block").groupBy(*KEY, "pos", "name")
             .agg(F.max("sha").alias("sha"), F.count(F.lit(1)).alias("copies")))
    plain = occ.join(by, "fp", "left_anti").join(named, "fp").drop("fp")
    return plain.unionByName(exact.select(plain.columns))


def text_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES, fp=fingerprint64) -> DataFrame:
    """(doc_id, h, len, sha, copies, level, name): one row per distinct
    document row; equal (level, name) means equal normalised text."""
    cur = cut_lineage(_name_blocks(docs, block_bytes, fp))
    width = f"greatest(1, (len - 1) div {block_bytes} + 1)"
    cur = cur.withColumn("n", F.expr(width))
    cols = [*KEY, "sha", "copies"]
    done, level = [], 0
    while True:
        done.append(cur.filter("n = 1").select(*cols, F.lit(level).alias("level"), "name"))
        more = cur.filter("n > 1")
        if more.isEmpty():
            break
        even = F.col("pos") % 2 == 0
        pairs = (more.groupBy(*KEY, "n", F.expr("cast(pos div 2 as int)").alias("pos"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(None).cast("long")).alias("b0"),
                      F.max(F.when(~even, F.lit(1))).alias("has_b"),
                      F.max("sha").alias("sha"), F.max("copies").alias("copies")))
        # an odd last name stands alone: has_b parts it from every real pair
        pairs = pairs.withColumn("has_b", F.coalesce("has_b", F.lit(0))).withColumn(
            "b", F.coalesce("b0", F.lit(0).cast("long"))).drop("b0")
        names = cut_lineage(_numbered(pairs.select("a", "b", "has_b").distinct(), ["a", "b", "has_b"], "name"))
        cur = cut_lineage(pairs.join(names, ["a", "b", "has_b"]).select(
            *cols, "pos", "name", F.expr("(n + 1) div 2").alias("n")))
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, fp=fingerprint64) -> DataFrame:
    """One row per document row: doc_id, keep_id (largest id of its group),
    group_size, kept, text_sha256, and the row's key (h, len, copies)."""
    names = cut_lineage(text_names(docs, block_bytes, fp))
    # a table of its own: a join of two tables is one that AQE splits at a hot name
    groups = cut_lineage(names.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"),
                                                            F.sum("copies").alias("group_size")))
    rows = names.join(groups, ["level", "name"])
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return rows.select("*", copy).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"), "h", "len", "copies")


def keep_one_of_each(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (all its columns) without the exact copies that go."""
    rows = cut_lineage(exact_dedup(docs, block_bytes).groupBy(*KEY).agg(
        F.max("kept").alias("kept"), F.max("copies").alias("copies")))
    names = ["__dup_id", "__dup_h", "__dup_len"]
    as_key = [F.col(a).alias(b) for a, b in zip(KEY, names)]
    norm = ascii_lower(text_or_empty(docs))
    return drop_rows(docs, [docs["doc_id"].cast("long"), *_row_key(norm)], names,
                     rows.filter("not kept").select(*as_key),
                     rows.filter("kept and copies > 1").select(*as_key))
