"""Secret scans against Python's regular expressions."""

import hashlib
import random
import re
from collections import Counter

from tests.llm.helpers import CLASHING, frame, odd_rows
from tillroll.llm import queries, secret_scan

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
MORE = [(i, re.compile(r.pattern)) for i, r in enumerate(secret_scan.RULES) if i >= 3]


def brute(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    more = [(m.start(), k, m.end()) for k, p in MORE for m in p.finditer(text)]

    def join(spans):
        return ",".join(f"{secret_scan.RULES[k].kind}:{a}:{b}" for a, k, b in sorted(spans))

    return (*[sum(k == n for _, k, _ in base) for n in range(3)], hashlib.sha256(join(base).encode()).hexdigest(),
            join(base + more))


def check(rows, got):
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter(tuple(r[c] for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"))
                   for r in got) == want


def test_made_up_texts(spark):
    rng = random.Random(3)
    bits = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdef", "abc", "é",
            "😀", "AKIA", "0123456789ABCDEF", "AKIAAKIA", "0123456789abcdef01234567", "deadbeef", "\n", "x" * 30, "Z", "-",
            "ſecret", "toKen", "xoxb-", "-----BEGIN RSA PRIVATE KEY-----", "eyJ", "AIza" + "k" * 35, "abcdefghij."]
    rows = [(i if i % 7 else None, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(2000)]
    rows += [(5, None), (5, ""), (5, "token=abcdefg"), (5, "token=abcdefg"), (6, "secret=token:abcdefgh")]
    rows += odd_rows(long=4000) + [(70, "a" * 90_000), (71, "password = " + "A" * 90_000)]
    check(rows, secret_scan.digest(secret_scan.scan(frame(spark, rows, CLASHING))).collect())


def test_whole_query_and_empty(spark, empty):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(rows, queries.QUERIES["op6_secret_scan"](spark, SF).collect())
    assert secret_scan.digest(secret_scan.scan(empty)).count() == 0
    only_full = (secret_scan.BASE[2],)
    found = secret_scan.scan(frame(spark, [(1, "f" * 30)]), only_full).first()["found"]
    assert [tuple(s) for s in found] == [(0, 0, 30)]


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q("[0-9a-f]{24,}") is None and q("ab") is None and q("(abc|x)") is None
    assert q("abcd") == [frozenset({"abc", "bcd"})]
    assert q("ab?cd") == [frozenset({"abc", "bcd"}), frozenset({"acd"})]
    assert q("(abc)+d") == [frozenset({"abc"})] and q("(abc)*def") == [frozenset({"def"})]
    assert q("(?i:ABC)[xy]def") == [frozenset({"abc", "def"})]


def test_candidates_hold_every_match():
    """A text that a rule matches satisfies the rule's query."""
    rng = random.Random(9)
    parts = ["password", "api_key", "apikey", "=", "abcdefgh", "AKIA", "A1" * 10, " ", "tok", "en", "xoxb-", "z" * 12]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=6))
        for rule in secret_scan.RULES:
            alts = secret_scan.trigram_query(rule.pattern)
            if alts and re.search(rule.pattern, text):
                assert any(all(g in text.lower() for g in alt) for alt in alts)
