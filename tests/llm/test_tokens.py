"""Packing and token files: exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.helpers import CLASHING, frame, odd_rows
from tillroll.llm import packing, queries, token_orc, tokens
from tillroll.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def ids(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")


def check_pack(rows, got, tok, capacity):
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(ids(tok, t))
    assert sum(r["length"] for r in got) == sum(len(x) for v in texts.values() for x in v)
    for r in got:
        piece = [x[r["start"]:r["start"] + r["length"]] for x in texts[r["doc_id"]]]
        assert any(len(p) == r["length"] and zlib.crc32(p.tobytes()) == r["ids_crc32"] for p in piece)
        assert r["start"] == r["piece"] * capacity and 0 < r["length"] <= capacity
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_word_encoder_equals_the_library(tok):
    import random

    rng = random.Random(4)
    bits = ["Éa", "straße", "ÀÉÎ", "it's", "don't.", "x<|endoftext|>y", "<|ENDOFTEXT|>", "a..", "é", "naïve!!",
            "ñ&&&", "ﬁn", "İx", "Σς", "µm", "ªb", "12.5", "a1b", "日本語", " x", "a\x1cb", "'s", "x'.s", "Ǆ", "K",
            "�", "😀", "e­x", "a|>", "×", "Ab\x85c", "q" * 100, "é" * 80 + ".",
            # composed in lower case alone
            "J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "T\u0344", "J\u0323\u030cX.", "E\u0301A"]
    enc = tokens.WordEncoder(queries.vocabulary())
    for _ in range(1500):
        text = rng.choice([" ", "\n", "\t", "  "]).join(rng.choices(bits, k=rng.randint(0, 8)))
        want = np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert enc.encode(text.encode()) == want, text


@pytest.mark.parametrize("capacity", [4096, 50])
def test_packing(spark, tok, capacity):
    rows = odd_rows(long=9000)
    got = packing.pack_documents(frame(spark, rows, CLASHING), queries.vocabulary(), capacity).collect()
    n = check_pack(rows, got, tok, capacity)
    assert n <= 1.1 * sum(r["length"] for r in got) / capacity + 1


def test_packing_empty_and_whole_query(spark, tok, empty):
    assert packing.pack_documents(empty, queries.vocabulary()).count() == 0
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op2_best_fit_packing"](spark, SF).collect()
    n = check_pack(rows, got, tok, 4096)
    assert n <= 1.02 * sum(r["length"] for r in got) / 4096 + 1


def test_plan_pairs_large_items_and_fills_gaps():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cap = int(rng.integers(3, 60))
        lengths = {int(s): int(rng.integers(1, 9)) for s in rng.integers(1, cap + 1, size=rng.integers(1, 12))}
        plan = packing.plan_packing(lengths, cap)
        bins, placed = defaultdict(list), defaultdict(int)
        for length, rank, items, first, each, offset in plan.segments:
            assert rank == placed[length]
            placed[length] += items
            for k in range(items):
                bins[first + k // each].append((offset + (k % each) * length, length))
        assert placed == lengths and len(bins) == plan.bins
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= cap
            assert sum(3 * length > cap for _, length in parts) <= 2


def fewest_bins(items, cap):
    """By exhaustion: the least (bins, fill of the last) over all subsets."""
    best = [(1, 0)] + [(len(items) + 1, 0)] * (2 ** len(items) - 1)
    for mask in range(1, len(best)):
        for k, size in enumerate(items):
            if mask >> k & 1:
                n, fill = best[mask ^ 1 << k]
                best[mask] = min(best[mask], (n, fill + size) if fill + size <= cap else (n + 1, size))
    return best[-1][0]


def best_fit_decreasing(items, cap):
    gaps = []
    for size in sorted(items, reverse=True):
        fit = min((g for g in gaps if g >= size), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((cap if fit is None else fit) - size)
    return len(gaps)


def bins_of(items, cap):
    return packing.plan_packing({s: items.count(s) for s in items}, cap).bins


def test_plan_against_the_optimum_and_plain_best_fit():
    rng = np.random.default_rng(5)
    over = 0
    for _ in range(200):
        cap = int(rng.integers(6, 60))
        large = rng.integers(cap // 3 + 1, cap + 1, size=rng.integers(1, 10)).tolist()
        assert bins_of(large, cap) == fewest_bins(large, cap)  # pairs alone: the matching is the optimum
        mixed = rng.integers(1, cap + 1, size=rng.integers(1, 10)).tolist()
        least = fewest_bins(mixed, cap)
        assert least <= bins_of(mixed, cap) <= least + 1
        over += bins_of(mixed, cap) > least
        many = np.minimum(rng.geometric(0.08, size=300), cap).tolist()
        assert bins_of(many, cap) <= 1.02 * best_fit_decreasing(many, cap) + 1
    assert over <= 20


def test_token_files(spark, tok):
    rows = odd_rows(long=9000)
    path = f"{ensure_checkpoint_dir(spark)}/tokens-test"
    token_orc.write_token_orc(frame(spark, rows, CLASHING).repartition(5), path, queries.vocabulary(), stripe_bytes=1 << 16)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_orc.digests(spark, path).collect())
    # ids ascend, nulls first; rows of one id in the order of their texts
    at, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        x = ids(tok, t)
        want.append((at, i, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert got == want
    one = token_orc.lookup(spark, path, [10]).collect()
    assert [r["ids"] for r in one] == [ids(tok, dict(rows[:16])[10]).tolist()]
    plan = token_orc.lookup(spark, path, [10])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,10)]" in plan or "PushedFilters: [In(doc_id" in plan


def test_token_files_empty_and_whole_query(spark, tok, empty):
    path = f"{ensure_checkpoint_dir(spark)}/tokens-empty"
    token_orc.write_token_orc(empty, path, queries.vocabulary())
    assert token_orc.digests(spark, path).count() == 0
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_token_orc"](spark, SF).collect()}
    at = 0
    for i, t in sorted(tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()):
        x = ids(tok, t)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)
    assert len(got) == 200


def test_other_vocabularies_get_whole_texts():
    from array import array

    from tokenizers import Tokenizer
    from tillroll.llm.tokens import WordEncoder

    path = queries.vocabulary("byte_bpe_50k.json")
    tok, mine = Tokenizer.from_file(path), WordEncoder(path)
    assert not mine.by_words and WordEncoder(queries.vocabulary()).by_words
    for text in ("Plain Words  and\tblanks", "UPPER lower", " lead", "", "J\u030c é 語", "a <|endoftext|> b"):
        assert mine.encode(text.encode()) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()


def test_an_id_that_a_third_of_the_rows_lack(spark, tmp_path):
    """They go to several files and to even buckets; starts stay gapless."""
    rows = [(None if i % 3 == 0 else i, f"text {i * 7919 % 1000} of many") for i in range(3000)]
    docs = frame(spark, rows).repartition(4)
    path = f"file://{tmp_path}/tokens"
    token_orc.write_token_orc(docs, path, queries.vocabulary())
    whole = token_orc.read_token_orc(spark, path)
    null_parts = whole.filter("doc_id is null").groupBy("part").count().collect()
    assert len(null_parts) > 1 or whole.select("part").distinct().count() == 1
    got = sorted((r["start"], r["n_tokens"]) for r in token_orc.digests(spark, path).collect())
    at = 0
    for start, n in got:
        assert start == at
        at += n
    from pyspark.sql import functions as F

    pieces = packing.token_pieces(docs, queries.vocabulary())
    sizes = [r["count"] for r in pieces.groupBy(
        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(8)).alias("b")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 3000 / 8
