"""Fill-in-middle against plain Python over the tokens, and exact round trips."""

import hashlib
import random
import re
from collections import Counter

import duckdb

from tests.llm.helpers import CLASHING, frame, odd_rows
from tillroll.llm import fim, queries
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, cut_percent=50):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut_percent:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, rows, **parameters):
    out = fim.fill_in_middle(docs, **parameters)
    got = out.select("*", fim.restored(out["output"], out["form"]).alias("text")).collect()
    want = Counter((*brute(i, t, parameters.get("cut_percent", 50)), t or "") for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    return got


def test_odd_texts(spark):
    rng = random.Random(5)
    bits = ["<", ">", "P>", "<S", "S>", "M", "\\E", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", " ", " ", "é",
            "語", "😀", "a", "word", "x̌", "\x00"]
    rows = [(i if i % 9 else None, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(3000)]
    rows += [(5000 + i, t) for i, t in enumerate(["<P>", "a <S> b", "<M", " ", "\n\n", "a", " a", "a ", " a ", "<" * 40])]
    rows += odd_rows()
    got = check(frame(spark, rows, CLASHING), rows, cut_percent=90)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}


def test_whole_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    key = "op13_fill_in_middle"
    assert digest(queries.QUERIES[key](spark, SF).toPandas()) == digest(con.execute(queries.ORACLE[key]).df())
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(queries.table(spark, SF, "documents"), rows)


def test_empty(spark, empty):
    assert fim.fill_in_middle(empty).count() == 0
    assert check(frame(spark, [(1, None), (2, "")]), [(1, None), (2, "")])


def test_wavelet_matrix_ranks():
    import numpy as np

    rng = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 6, size).astype(np.uint8)
        matrix, places = fim.WaveletMatrix(symbols, 3), np.arange(size + 1)
        for c in range(6):
            assert (matrix.rank(c, places) == np.concatenate([[0], np.cumsum(symbols == c)])).all()
