"""SimHash near-dedup: fingerprints that differ in a few bits are linked.

A 64-bit fingerprint is eight bytes at eight positions.  Fingerprints that
differ in at most d bits differ in at most d bytes, so they share at least
8 - d positional bytes: that is the guaranteed minimum of matches.  The
inverted index lists fingerprints by positional bytes.  Its entries join
``KEY_BYTES`` positions each (a pair with 8 - d matches of 8 agrees on at
least that many of any d + KEY_BYTES positions), so one entry is an
intersection of single-byte postings and stays short.  Inside an entry the
shared positional bytes of a pair are tallied, pairs below the minimum go, the
rest are verified bit by bit, and only a spanning forest of the links leaves
the task: a group of n near copies gives at most n - 1 links per entry, not
n * n / 2 pairs.

Equal fingerprints are one node, so copies never meet in pairs.  An entry of
more than ``entry_limit`` different fingerprints is not compared pairwise: for
those fingerprints every value within d / 2 bits is listed (d odd: within
(d - 1) / 2 bits for one side and (d + 1) / 2 for the other), and two of them
are within d bits exactly when they list a common value.  That is linear in
the number of fingerprints and loses no link.

Defined cases: null text is empty; a text without words has fingerprint zero
and links like any other; fewer words than a shingle are one shingle; null
doc_ids are rows like any other and never name a component unless nothing else
does; repeated rows are returned each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, drop_rows, map_arrow, text_or_empty
from tillroll.llm.components import components
from tillroll.session import cut_lineage

SHINGLE_WORDS = 4
MAX_BITS = 4
KEY_BYTES = 3          # of an index entry, and one more
MANY_NODES = 10 ** 10  # from so many different fingerprints on
ENTRY_LIMIT = 8192
SEED = 42
_HASH_ROWS = 255 * 256  # shingle hashes counted at once


def _fingerprint(text: bytes, words_per: int) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: lowers A-Z only, splits at 20 and 09-0D
    if not words:
        return 0
    if len(words) <= words_per:
        return xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per))))
    n, counts = len(words) - words_per + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _HASH_ROWS):
        m = min(_HASH_ROWS, n - at)
        rows = -(-m // 255) * 255
        h = np.zeros(rows, dtype="<u8")
        h[:m] = np.fromiter((xxh64_intdigest(s, SEED) for s, _ in zip(shingles, range(m))), dtype="<u8", count=m)
        bits = np.unpackbits(h.view(np.uint8).reshape(rows, 8), axis=1, bitorder="little")
        counts += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, len, fp): one row per row; h and len part rows sharing an id."""

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            fps = np.fromiter((_fingerprint(t.as_py(), words_per) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))],
                                             ["doc_id", "h", "len", "fp"])

    text = text_or_empty(docs)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                      F.octet_length(text).alias("len"), text.alias("text"))
    return map_arrow(src, hashed, "doc_id long, h long, len int, fp long")


def _entries(fps: DataFrame, max_bits: int, key_bytes: int) -> DataFrame:
    """(key, fp): the index entries of every fingerprint."""
    keys = []
    for nth, positions in enumerate(combinations(range(min(8, max_bits + key_bytes)), key_bytes)):
        key = F.lit(nth).cast("long")
        for p in positions:
            byte = F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long"))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _near(fps, x, max_bits: int):
    """Which of ``fps`` link to ``x``: tally of shared bytes, then the bits."""
    import numpy as np

    diff = fps ^ x
    shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    out = np.zeros(len(fps), dtype=bool)
    some = np.flatnonzero(shared >= 8 - max_bits)
    out[some] = np.bitwise_count(diff[some]) <= max_bits
    return out


def _forest(fps, max_bits: int) -> tuple[list[int], list[int]]:
    """Links (node, a first node) that span the linked groups of ``fps``."""
    import numpy as np

    left, a, b = fps, [], []
    while len(left) > 1:
        first = left[0]
        group, todo, left = [], [first], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = _near(left, x, max_bits)
            found = left[near]
            left = left[~near]
            group.extend(found)
            todo.extend(found)
        a.extend(group)
        b.extend([first] * len(group))
    return a, b


def _entry_links(max_bits: int):
    """mapInArrow function over entries sorted by key: links inside each."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def links(key, fp):
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            two = starts[sizes == 2]
            x, y = fp[two], fp[two + 1]
            diff = x ^ y
            shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            ok = (shared >= 8 - max_bits) & (np.bitwise_count(diff) <= max_bits)
            a, b = [x[ok]], [y[ok]]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                u, v = _forest(fp[s:s + n], max_bits)
                a.append(np.array(u, dtype=np.uint64))
                b.append(np.array(v, dtype=np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"])

        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(key):
                continue
            whole = int(np.searchsorted(key, key[-1]))  # the last entry may go on in the next batch
            if whole:
                yield links(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield links(key, fp)

    return run


def _values_near(fps: DataFrame, bits: int) -> DataFrame:
    """(fp, mid): every value within ``bits`` of each fingerprint."""
    masks = [sum(1 << b for b in chosen) for r in range(bits + 1) for chosen in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    values = F.expr("array(" + ",".join(f"{m}L" if m != -(1 << 63) else "shiftleft(1L, 63)" for m in signed) + ")")
    return fps.select("fp", F.explode(values).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Exact links for fingerprints of large entries, linear in their number.

    All that list a value farther off are linked to the least that lists it
    nearer by; those that list it nearer by list it farther off as well."""
    near = _values_near(fps, max_bits // 2)
    far = _values_near(fps, max_bits - max_bits // 2) if max_bits % 2 else near
    least = near.groupBy("mid").agg(F.min("fp").alias("b"), F.max("fp").alias("top"))
    if not max_bits % 2:
        least = least.filter("b <> top")
    return far.join(least.drop("top"), "mid").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS, key_bytes: int = KEY_BYTES,
          entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """(a, b): links whose components are those of all pairs of distinct
    fingerprints within ``max_bits``.  ``fps``: a written table of distinct fp."""
    entries = _entries(fps, max_bits, key_bytes)
    large = cut_lineage(entries.groupBy("key").count().filter(F.col("count") > entry_limit).select("key"))
    n_large = large.count()
    plain = entries
    if n_large:
        by = broadcast_checked(large, n_large)
        plain = entries.join(by, "key", "left_anti")
    out = map_arrow(plain.repartition("key").sortWithinPartitions("key", "fp"), _entry_links(max_bits),
                    "a long, b long")
    if n_large:
        hot = entries.join(by, "key", "left_semi").select("fp").distinct()
        out = out.union(_midpoint_links(cut_lineage(hot), max_bits))
    return out


def near_groups(rows: DataFrame, max_bits: int = MAX_BITS, key_bytes: int | None = None,
                entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """``rows`` (with doc_id, fp; a written table) and their component_id.
    The width of an index entry follows from the number of fingerprints
    unless ``key_bytes`` states it; any width finds the same links."""
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    if key_bytes is None:
        key_bytes = min(KEY_BYTES + (nodes.count() >= MANY_NODES), 8 - max_bits)
    roots = cut_lineage(components(links(nodes.select("fp"), max_bits, key_bytes, entry_limit)))
    tree = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    named = tree.groupBy("root").agg(F.min("first").alias("component_id"))
    # a table of its own: a join of two tables is one that AQE splits at a hot fingerprint
    return rows.join(cut_lineage(tree.select("fp", "root").join(named, "root").drop("root")), "fp")


def simhash_dedup(docs: DataFrame, words_per: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                  key_bytes: int | None = None, entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """doc_id, h, len, fp (signed), fingerprint (hex), component_id per row."""
    rows = cut_lineage(fingerprints(docs, words_per))
    return near_groups(rows, max_bits, key_bytes, entry_limit).withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def keep_one_of_group(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the smallest doc_id of every group of near copies."""
    rows = cut_lineage(simhash_dedup(docs, **parameters).groupBy("doc_id", "h", "len", "component_id")
                       .agg(F.count(F.lit(1)).alias("copies")))
    me = F.struct(F.col("doc_id").isNull(), "doc_id", "h", "len")
    first = rows.groupBy("component_id").agg(F.min(me).alias("stay"))
    flagged = cut_lineage(rows.join(first, rows["component_id"].eqNullSafe(first["component_id"])).select(
        *[F.col(c).alias(f"__near_{c}") for c in ("doc_id", "h", "len")], "copies",
        me.eqNullSafe(F.col("stay")).alias("stays")))
    names = ["__near_doc_id", "__near_h", "__near_len"]
    text = text_or_empty(docs)
    return drop_rows(docs, [docs["doc_id"].cast("long"), F.xxhash64(text), F.octet_length(text)], names,
                     flagged.filter("not stays").select(*names),
                     flagged.filter("stays and copies > 1").select(*names))
