"""Fill-in-middle transformation over a wavelet matrix of character classes.

Every byte of a slice of texts gets a class: a byte inside a character or its
first byte, either of them last of its token or not, white space, and white
space that ends a text.  The wavelet matrix answers "how many bytes of class c
lie before place i" for many places at once.  Sums of such ranks count the
tokens that end before a place (``boundaries``) and the code points before it
(``characters``), so the number of tokens is a difference of two counts and a
cut behind a given number of tokens is found by bisection on them; no list of
tokens is ever built.

Scale: a row's result depends on its own text and id alone, so the job is one
pass without a shuffle; a task holds a slice of about a megabyte, or one text.

Defined cases: null text is empty; an empty text is plain with no tokens; a
text of white space is one token; a text that holds a marker is plain; the
text after the last cut may be empty, as may prefix and middle; a null doc_id
hashes like the seed with nothing behind it; rows that repeat an id are cut by
the same hashes; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, text_or_empty

SEED = 42
CUT_PERCENT = 50  # of the documents that are cut at all
SPM_PERCENT = 80  # of those with the suffix first
MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

# classes of bytes
INNER, INNER_END, FIRST, FIRST_END, BLANK, BLANK_END = range(6)
LEVELS = 3


class Bits:
    """A bit vector with rank: 64 bits a word and the ones before each word."""

    def __init__(self, bits):
        import numpy as np

        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(packed) // 8 + 1, dtype="<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate([[0], ones[:-1]])
        self.zeros = len(bits) - int(ones[-1])

    def rank(self, i):
        """Ones before each place of ``i``."""
        import numpy as np

        word, low = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Ranks of the symbols of a sequence, highest bit first; at every level
    the symbols with bit 0 come before those with bit 1."""

    def __init__(self, symbols, levels: int):
        import numpy as np

        self.levels = []
        for bit in range(levels - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, i):
        """How often ``symbol`` occurs before each place of ``i``."""
        import numpy as np

        first, last = np.zeros_like(i), i
        for bit, bits in self.levels:
            a, b = bits.rank(first), bits.rank(last)
            first, last = (bits.zeros + a, bits.zeros + b) if symbol >> bit & 1 else (first - a, last - b)
        return last - first


class CutText:
    """Texts one after the other, with the places between their tokens."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.stop = np.cumsum(size)
        self.start = self.stop - size
        self.matrix = WaveletMatrix(self._classes(np.frombuffer(b"".join(texts), dtype=np.uint8), size), LEVELS)
        self.tokens = self.boundaries(self.stop) - self.boundaries(self.start)

    def _classes(self, data, size):
        import numpy as np

        kinds = np.full(256, FIRST, dtype=np.uint8)
        kinds[0x80:0xC0] = INNER
        kinds[list(BLANKS)] = BLANK
        kind = kinds[data]
        ends = self.stop[size > 0] - 1
        last = np.zeros(len(data), dtype=bool)
        last[:-1] = kind[1:] == BLANK
        last[kind == BLANK] = False
        last[ends] = True
        return kind + last  # the class of a token's last byte follows the plain one

    def boundaries(self, i):
        """Tokens that end before each place."""
        return sum(self.matrix.rank(c, i) for c in (INNER_END, FIRST_END, BLANK_END))

    def characters(self, i):
        """Code points that begin before each place."""
        return i - self.matrix.rank(INNER, i) - self.matrix.rank(INNER_END, i)

    def behind(self, tokens):
        """The first place of each text with so many of its tokens before it."""
        import numpy as np

        low, high, want = self.start, self.stop, self.boundaries(self.start) + tokens
        while (low < high).any():
            mid = (low + high) >> 1
            enough = self.boundaries(mid) >= want
            low, high = np.where(enough, low, np.minimum(mid + 1, high)), np.where(enough, mid, high)
        return low


def _arranged(form: str, text: bytes, a: int, b: int, marks: list[bytes]) -> bytes:
    p, s, m = marks
    if form == "psm":
        return b"".join((p, text[:a], s, text[b:], m, text[a:b]))
    if form == "spm":
        return b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return text


def fill_in_middle(docs: DataFrame, seed: int = SEED, cut_percent: int = CUT_PERCENT,
                   spm_percent: int = SPM_PERCENT, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per row.

    Cuts and form come from the SHA-256 of ``seed:doc_id``: its first two
    groups of eight digits place the cuts between tokens, the third decides
    whether the text is cut, the fourth the order of its parts."""
    marks = [m.encode() for m in markers]

    def transform(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from tillroll.llm.tokens import text_slices

        for batch in batches:
            for first, texts in text_slices(batch, 1):
                part = batch.slice(first, len(texts))
                cut = CutText(texts)
                one, two = (part.column(c).to_numpy() % (cut.tokens + 1) for c in (2, 3))
                a, b = cut.behind(np.minimum(one, two)), cut.behind(np.maximum(one, two))
                chars = cut.characters(a)
                prefix, middle = chars - cut.characters(cut.start), cut.characters(b) - chars
                forms = part.column(4).to_pylist()
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                output = [_arranged(f, t, i, j, marks) for f, t, i, j in zip(
                    forms, texts, (a - cut.start).tolist(), (b - cut.start).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cut.tokens), part.column(4), pa.array(prefix, mask=plain),
                     pa.array(middle, mask=plain), pa.array(output, pa.binary())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    text = text_or_empty(docs)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4))
    whole = F.octet_length(text) == 0
    for m in markers:
        whole = whole | F.contains(text, F.lit(m))
    form = (F.when(whole | (h3 % 100 >= cut_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"),
                      form.alias("form"))
    out = map_arrow(src, transform,
                    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from.  A text with a marker is plain
    and a marker cannot arise where a part meets one, so the three markers of
    the other forms are the only ones."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    one, two, three = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one))
            .otherwise(output))
