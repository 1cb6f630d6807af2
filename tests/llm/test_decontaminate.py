"""Benchmark decontamination against a plain search for word runs."""

import random
import re
from collections import Counter

import duckdb
import pytest

from tests.llm.helpers import CLASHING, WORDS, ascii_lower, frame, odd_rows
from tillroll.llm import decontaminate, queries
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(ascii_lower(text))


def brute(rows, items, window):
    runs = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1):
            if w:
                runs.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    sizes = {len(r) for r in runs}
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                names = runs.get(tuple(w[i:i + k]))
                if names:
                    hit.update(range(i, i + k))
                    found |= names
        yield doc_id, len(w), tuple(sorted(hit)), tuple(sorted(found))


def results(found):
    return Counter((r["doc_id"], r["n_words"], tuple(i for s in r["spans"] for i in range(s["start"], s["stop"])),
                    tuple(r["items"])) for r in found.collect())


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="module")
def case():
    """Few words, so that runs meet often; items of 0 to 60 words, some long
    in bytes; whole, partial and odd copies of them in the documents."""
    rng = random.Random(11)
    items = [(i if i % 11 else None, " ".join(rng.choices(WORDS, k=rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 30, 60]))))
             for i in range(60)]
    items = [(i, t if len(t.split()) != 1 else t + "x") for i, t in items]
    items += [(7, "Ä é 語"), (7, "other text of the same item " * 3), (8, None), (9, "..."), (12, "l" * 700), (13, "a b"),
              (14, "A-B"), (15, "a1 2b")]
    rows = list(odd_rows(long=3000))
    for j in range(300):
        part = words(rng.choice(items)[1])
        at = rng.randint(0, max(len(part) - 3, 0))
        sep = rng.choice([" ", "\n", " -- ", ", ", "\x7f"])
        rows.append((j if j % 13 else None, sep.join(rng.choices(WORDS, k=rng.randint(0, 12)) + part[at:at + rng.randint(0, 70)]
                                                     + rng.choices(WORDS, k=rng.randint(0, 12))).title()))
    rows += [(900, "ä É 語"), (901, "x Ä é 語 x"), (902, "k " + "l" * 700 + " k"), (903, "l" * 701), (904, "a.b"), (905, "xa b"),
             (906, "a b"), (906, "a b"), (907, "A\x00B")]
    return rows, items


@pytest.mark.parametrize("window, blocks", [(10, 1), (3, 1), (10, 5)])
def test_every_occurrence(spark, case, window, blocks):
    rows, items = case
    size = decontaminate.BLOCK_BYTES
    if blocks > 1:
        size = sum(len(t or "") for _, t in items) // blocks
    got = decontaminate.find_leaks(frame(spark, rows, (*CLASHING, "spans", "items", "pass")),
                                   benchmark(spark, items).withColumnRenamed("x", "y"), window, size)
    want = Counter(brute(rows, items, window))
    assert results(got) == want
    assert all(a["stop"] < b["start"] for r in got.collect() for a, b in zip(r["spans"], r["spans"][1:]))
    assert sum(bool(k[2]) for k in want) > 100


def test_segments_lose_no_run(spark):
    rng = random.Random(4)
    text = " ".join(str(rng.randint(0, 999)) for _ in range(95))
    items = [(i, " ".join(text.split()[:n])) for i, n in enumerate((95, 94, 40, 31, 30, 29, 10, 9, 1))]
    cut = [(r["item"], r["text"]) for r in decontaminate.segments_of(benchmark(spark, items), 10, 10).collect()]
    for i, t in items:
        w = t.split()
        runs = {tuple(w[k:k + 10]) for k in range(max(len(w) - 10, 0) + 1)}
        parts = [s.split() for n, s in cut if n == str(i)]
        assert runs == {tuple(s[k:k + 10]) for s in parts for k in range(max(len(s) - 10, 0) + 1)}
        assert all(len(s) <= 19 for s in parts)


def test_whole_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    key = "op12_benchmark_decontamination"
    got = queries.QUERIES[key](spark, SF).toPandas()
    assert got["contaminated"].any() and not got["contaminated"].all()
    assert digest(got) == digest(con.execute(queries.ORACLE[key]).df())


def test_empty_tables(spark, empty):
    none = benchmark(spark, [])
    assert decontaminate.find_leaks(empty, none).count() == 0
    assert decontaminate.find_leaks(empty, benchmark(spark, [(1, "a b c")])).count() == 0
    rows = [(1, "a b c"), (2, None)]
    got = decontaminate.find_leaks(frame(spark, rows), none)
    assert results(got) == Counter([(1, 3, (), ()), (2, 0, (), ())])


def test_shift_table_finds_what_a_plain_search_finds():
    rng = random.Random(8)
    for least in (1, 3, 7, 20, 60):
        text = bytes(rng.choices(b"ab ", k=5000))
        strings = [text[i:i + least + rng.randint(0, 9)] for i in rng.sample(range(4900), 40)]
        strings = sorted({*strings, b"z" * least})
        found = sorted(decontaminate.ShiftTable(strings).find(text))
        assert found == sorted((i, k) for k, s in enumerate(strings) for i in range(len(text)) if text.startswith(s, i))
