"""Benchmark decontamination by Wu-Manber search for many strings at once.

A text is reduced to its words (lower-cased, one blank between them), a test
item to the runs of ten consecutive words that it has; an item of fewer words
is one run.  Every occurrence of a run in a document is found:

* the strings are sorted into classes by length, so that a short one does not
  shorten the steps taken for the long ones;
* a class has a shift table over blocks of bytes: how far the end of the
  window may move before the block under it could be part of any string.
  Blocks that occur in no string move it by nearly the whole window;
* where the shift is 0 the block is the end of some string's window: the
  bucket of that suffix hash names the strings, the first bytes of the window
  choose among them, and the bytes themselves are compared.

A slice of texts is searched in many lanes side by side, each with a window of
its own, so that the steps are numpy operations.

Scale: the documents are read in one pass without a shuffle.  The test items
are cut into segments (overlapping by nine words, so no run is lost) and the
segments dealt into blocks of about ``BLOCK_BYTES``; a task holds the tables of
one block.  One block is the usual case; for more there is a pass for each,
and the spans of a document are merged by its key.

Defined cases: null text has no words; an item without words takes no part; a
null item_id is an item named by the empty string; rows that share an item_id
are one item of several texts; a document without words is clean; rows that
repeat are kept; without benchmark items every document is clean; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import UPPER, map_arrow, text_or_empty
from tillroll.session import cut_lineage, measured

WINDOW = 10            # words
SEGMENT = 10_000       # words of an item handled as one row
BLOCK_BYTES = 2 << 20  # of test items whose tables a task holds
CHUNK = 8              # bytes of a Wu-Manber block, at most
LANE = 1024            # bytes of text searched by one lane
MIX = 0x9E3779B97F4A7C15  # odd multiplier of the table's hash
# fixed value: characters that end a word, after lower-casing A-Z
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _byte_table() -> bytes:
    """Bytes of words as they stand, A-Z lower-cased, all others a blank."""
    words = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in words else 32 for b in range(256))


class ShiftTable:
    """Wu-Manber tables of strings of at least ``m`` bytes."""

    def __init__(self, strings: list[bytes]):
        import numpy as np

        self.strings = strings
        self.m = m = min(map(len, strings))
        self.chunk = chunk = min(CHUNK, m)
        heads = np.frombuffer(b"".join(s[:m] for s in strings), dtype=np.uint8).reshape(-1, m)
        self.bits = min(24, max(10, (8 * len(strings) * (m - chunk + 1)).bit_length()))
        self.shift = np.full(1 << self.bits, m - chunk + 1, dtype=np.int64)
        for j in range(m - chunk + 1):  # later blocks allow smaller steps and overwrite
            suffix = self._slot(self._codes(heads[:, j:j + chunk]))
            self.shift[suffix] = m - chunk - j
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.prefix = self._codes(heads[:, :chunk])[self.order]

    @staticmethod
    def _codes(rows):
        import numpy as np

        wide = np.zeros((len(rows), 8), dtype=np.uint8)
        wide[:, :rows.shape[1]] = rows
        return wide.view("<u8").ravel()

    def _slot(self, codes):
        import numpy as np

        return (codes * np.uint64(MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, string) of every occurrence."""
        import numpy as np

        data, block = np.frombuffer(text, dtype=np.uint8), np.arange(self.chunk)
        end = np.arange(self.m, len(data) + 1, LANE)  # one past the window, for each lane
        stop = np.minimum(end + LANE, len(data) + 1)
        ends, slots = [], []
        while len(end):
            slot = self._slot(self._codes(data[(end - self.chunk)[:, None] + block]))
            step = self.shift[slot]
            hit = step == 0
            if hit.any():
                ends.append(end[hit])
                slots.append(slot[hit])
                step = np.maximum(step, 1)
            end = end + step
            going = end < stop
            if not going.all():
                end, stop = end[going], stop[going]
        if not ends:
            return
        places, slot = np.concatenate(ends) - self.m, np.concatenate(slots)
        low, high = np.searchsorted(self.suffix, slot, "left"), np.searchsorted(self.suffix, slot, "right")
        size = high - low  # strings of the bucket
        place = np.repeat(places, size)
        which = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        start = self._codes(data[places[:, None] + block])
        near = np.repeat(start, size) == self.prefix[which]
        for at, k in zip(place[near].tolist(), self.order[which[near]].tolist()):
            if text.startswith(self.strings[k], at):
                yield at, k


class Searcher:
    """All runs of the segments of a block, by class of length."""

    def __init__(self, segments: list[tuple[str, str]], window: int):
        named: dict[bytes, list[str]] = {}
        for item, text in segments:
            line = b" " + text.encode() + b" "
            gaps = [i for i, b in enumerate(line) if b == 32]
            size = min(window, len(gaps) - 1)
            for a, b in zip(gaps, gaps[size:]):
                names = named.setdefault(line[a:b + 1], [])
                if item not in names[-1:]:  # segments come sorted by item
                    names.append(item)
        classes: dict[int, list[bytes]] = {}
        for run in named:
            classes.setdefault(len(run).bit_length(), []).append(run)
        self.tables = [(ShiftTable(runs), [named[r] for r in runs], [r.count(b" ") - 1 for r in runs])
                       for _, runs in sorted(classes.items())]

    def find(self, text: bytes) -> Iterator[tuple[int, int, list[str]]]:
        """(place, words, items) of every occurrence."""
        for table, items, words in self.tables:
            for at, k in table.find(text):
                yield at, words[k], items[k]


def _searched(texts: list[bytes], searcher: Searcher, table: bytes):
    """Of a slice of texts: words of each, spans of hit words (row, start,
    stop) in order, and the items of each row that has any."""
    import numpy as np

    raw = np.frombuffer(b"".join([b" %b \n" % t.translate(table) for t in texts]), dtype=np.uint8)
    keep = raw != 32
    keep[0] = True
    keep[1:] |= raw[:-1] != 32  # the first blank of a run stays
    flat = raw[keep]
    text = flat.tobytes()
    rows = np.concatenate([[0], np.flatnonzero(flat == 10)[:-1] + 1])
    blanks = np.flatnonzero(flat == 32)  # the blank before each word, and one behind the last of a text
    first = np.searchsorted(blanks, rows)
    words = np.diff(np.append(first, len(blanks))) - 1
    place, size, items = [], [], {}
    for at, n, names in searcher.find(text):
        place.append(at)
        size.append(n)
        items.setdefault(at, []).extend(names)
    place, size = np.array(place, dtype=np.int64), np.array(size, dtype=np.int64)
    word = np.searchsorted(blanks, place)
    change = np.zeros(len(blanks) + 1, dtype=np.int64)
    np.add.at(change, word, 1)
    np.add.at(change, word + size, -1)
    hit = np.concatenate([[0], np.cumsum(change) > 0, [0]]).astype(np.int8)
    turn = np.diff(hit)
    start, stop = np.flatnonzero(turn > 0), np.flatnonzero(turn < 0)
    row = np.searchsorted(first, start, "right") - 1
    found: dict[int, set] = {}
    at_row = np.searchsorted(rows, np.fromiter(items, dtype=np.int64, count=len(items)), "right") - 1
    for r, names in zip(at_row.tolist(), items.values()):
        found.setdefault(r, set()).update(names)
    return words, (row, start - first[row], stop - first[row]), found


def _scan(segments: list[tuple[str, str]], window: int):
    """mapInArrow function: (key columns, text) -> key columns and results."""
    table = _byte_table()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from tillroll.llm.tokens import text_slices

        searcher = Searcher(segments, window)
        for batch in batches:
            for at, texts in text_slices(batch, 3):
                words, (row, start, stop), found = _searched(texts, searcher, table)
                n = len(texts)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                spans = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                    [pa.array(start, pa.int64()), pa.array(stop, pa.int64())], ["start", "stop"]))
                items = pa.array([sorted(found[r]) if r in found else [] for r in range(n)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(at, n) for c in batch.columns[:3]], pa.array(words, pa.int64()), spans, items],
                    ["doc_id", "h", "len", "n_words", "spans", "items"])

    return run


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))


def segments_of(benchmark: DataFrame, window: int = WINDOW, segment: int = SEGMENT) -> DataFrame:
    """(item, start, text): the words of every item in pieces that overlap by
    a window less one word, so that each run of an item lies in one of them."""
    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item"),
                             words_of(text_or_empty(benchmark)).alias("words"))
    n = F.size("words")
    starts = F.filter(F.sequence(F.lit(0), n - 1, F.lit(segment)), lambda s: (s == 0) | (s + window <= n))
    cut = items.filter(n > 0).select("item", "words", F.explode(starts).alias("start"))
    return cut.select("item", "start", F.array_join(F.slice("words", F.col("start") + 1, segment + window - 1), " "
                                                    ).alias("text")).distinct()


def _merged(spans: Column) -> Column:
    """Spans in order, joined where they touch or overlap."""
    span = "struct<start:bigint,stop:bigint>"
    none = F.array().cast(f"array<{span}>")

    def step(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        longer = F.struct(last["start"], F.greatest(last["stop"], s["stop"])).cast(span)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))
        return F.when((F.size(acc) > 0) & (s["start"] <= last["stop"]), joined).otherwise(F.array_append(acc, s))

    return F.aggregate(F.array_sort(spans), none, step)


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items): one row per row of ``docs``; ``spans``
    are the ranges of words inside an occurrence of a run of the benchmark
    (numbers from 0, stop exclusive, in order, apart), ``items`` the sorted
    ids of the items whose runs occur."""
    segments = cut_lineage(segments_of(benchmark, window))
    _, size = measured(segments)
    blocks = max(1, math.ceil(size / block_bytes))
    place = F.pmod(F.xxhash64("item", "start", "text"), F.lit(blocks))
    text = text_or_empty(docs)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                      F.octet_length(text).alias("len"), text.alias("text"))
    found = []
    for b in range(blocks):
        # about ``block_bytes``: a segment is at most ``SEGMENT`` words
        rows = segments.filter(place == b).orderBy("item", "start", "text").collect()
        scan = _scan([(r["item"], r["text"]) for r in rows], window)
        found.append(map_arrow(src, scan, "doc_id long, h long, len int, n_words long, "
                                          "spans array<struct<start:long,stop:long>>, items array<string>"))
    if blocks == 1:
        return found[0].drop("h", "len")
    # a pass is written before the next begins, so one block's tables are held at a time
    every = cut_lineage(found[0].withColumn("pass", F.lit(0)))
    for b, part in enumerate(found[1:], 1):
        every = every.unionByName(cut_lineage(part.withColumn("pass", F.lit(b))))
    # rows that repeat id and text have equal results, so the sets hold one entry per pass
    each = every.groupBy("doc_id", "h", "len", "n_words").agg(
        F.count_if(F.col("pass") == 0).alias("m"),
        F.collect_set(F.struct("pass", "spans", "items")).alias("passes"))
    merged = each.select(
        "doc_id", "n_words", _merged(F.flatten("passes.spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten("passes.items"))).alias("items"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy"))
    return merged.drop("copy")


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
