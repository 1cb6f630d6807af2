"""Token ids of whole texts by the `tokenizers` library, with a word memo.

The library's word vocabulary cuts texts at white space before anything else,
so a text's ids are its words' ids one after the other.  A worker keeps the
ids of the words it has met (two generations of a bounded dict) and sends only
new words to the library.  Texts are split at the ASCII blanks alone, which
the library treats as white space too; what other blanks and signs do is left
to it.  Lower-casing A-Z first changes nothing (the vocabulary lower-cases)
with two exceptions: texts that hold ``<|`` (spelled-out special tokens) skip
it, and so do words with a combining mark, which the library composes before
it lower-cases (there is a composed j with caron, but no J).

A word of Latin letters is one piece to the library's splitter and needs no
normalising, so it goes to the library's model directly, which costs a third;
a run of signs behind it is a piece of its own.

All this holds for vocabularies that work like the word vocabulary
(``cuts_at_blanks``); of any other, whole texts are given to the library.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

MEMO_WORDS = 300_000   # of each of the two generations
MEMO_BYTES = 64        # longer words are not kept
# signs that end a word; an apostrophe may begin a contraction, so it is not one
SIGNS = string.punctuation.replace("'", "").encode()
# the model's letters for the bytes of UTF-8: printable ones stand for
# themselves, the others follow from 256 on
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
BYTE_LETTERS = "".join(chr(256 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256))
ID_BYTES: list[bytes] = []  # of every id of the vocabulary
SLICE_BYTES = 1 << 20  # texts are handled in slices of about this size


def _words(text: bytes) -> list[bytes]:
    """The words, A-Z lower-cased where that leaves the ids alone.  0xCC and
    0xCD lead U+0300 to U+037F, the marks that compose with Latin letters."""
    if b"<|" in text:
        return text.split()
    if b"\xcc" in text or b"\xcd" in text:
        return [w if b"\xcc" in w or b"\xcd" in w else w.lower() for w in text.split()]
    return text.lower().split()


def cuts_at_blanks(config: dict) -> bool:
    """Whether a tokenizer, as its file describes it, lower-cases, composes
    and drops blanks, cuts at them first and marks the ends of words, so that
    a text's ids are its words' ids."""
    normal, split = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    steps = [(n["type"], n.get("content")) for n in normal.get("normalizers", [])]
    cut = [(p["type"], p.get("behavior"), p.get("invert"), p.get("add_prefix_space")) for p in split.get("pretokenizers", [])]
    return (steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
            and cut == [("Split", "Removed", True, None), ("ByteLevel", None, None, False)]
            and split["pretokenizers"][0]["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+")
            and config["model"].get("end_of_word_suffix") == "</w>")


class WordEncoder:
    """bytes of a text -> little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.by_words = cuts_at_blanks(json.loads(self.tok.to_str()))
        while len(ID_BYTES) < self.tok.get_vocab_size():
            ID_BYTES.append(len(ID_BYTES).to_bytes(4, "little"))
        self.signs: dict[bytes, bytes] = {}
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, word: bytes) -> bytes:
        return array("I", self.tok.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def _plain(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters with nothing but signs behind it;
        None for any other word."""
        base = word if word.isalpha() else word.rstrip(SIGNS)
        if base.isalpha():  # A-Z and a-z alone
            text = base.lower().decode()
        else:
            text = base.decode("utf-8", "replace")
            if not text.isalpha() or max(text) > "\xff":
                return None
            text = charmap_decode(text.lower().encode(), "strict", BYTE_LETTERS)[0]
        ids = self.memo.get(base) if len(base) < len(word) else None
        if ids is None:
            ids = b"".join([ID_BYTES[t.id] for t in self.model.tokenize(text)])
        return ids + self._signs(word[len(base):]) if len(base) < len(word) else ids

    def _signs(self, signs: bytes) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            if len(self.signs) > 10_000:
                self.signs.clear()
            ids = self.signs[signs] = self._whole(signs)
        return ids

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word that is not in the memo; short ones are kept."""
        v = self.old.get(word)
        if v is None:
            v = self._plain(word) if len(word) <= MEMO_BYTES else None
            if v is None:
                v = self._whole(word)
            if len(word) > MEMO_BYTES:
                return v
        self.memo[word] = v
        return v

    def encode(self, text: bytes) -> bytes:
        if not self.by_words:
            return self._whole(text)
        words = _words(text)
        found = list(map(self.memo.get, words))
        if None in found:
            if len(self.memo) > MEMO_WORDS:
                self.old, self.memo = self.memo, {}
            get, ids = self.memo.get, self._ids
            found = [v if v is not None else (get(w) or ids(w)) for v, w in zip(found, words)]
        return b"".join(found)

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        return list(map(self.encode, texts))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def text_slices(batch, column: int, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Of an Arrow batch: (number of the first row, texts), in slices of about
    ``slice_bytes``, so that only a slice is held twice."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = batch.column(column).cast(pa.binary())
    first, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= slice_bytes or i == len(texts) - 1:
            yield first, [t or b"" for t in texts.slice(first, i + 1 - first).to_pylist()]
            first, size = i + 1, 0


def encoded_slices(batch, path: str, text: int, end_id: int) -> Iterator[tuple[int, list[bytes]]]:
    """Of an Arrow batch: (number of the first row, ids as bytes with the end id)."""
    end = array("I", [end_id]).tobytes()
    enc = encoder(path)
    for first, texts in text_slices(batch, text):
        yield first, [ids + end for ids in enc.encode_many(texts)]


def crc(ids) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
