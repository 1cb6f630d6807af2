"""Mixing by pivotal rounding: targets, totals, reruns."""

import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import CLASHING, frame, odd_rows
from tillroll.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows, weights=(5, 2, 1), most=3):
    size = Counter()
    for _, t, s in rows:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * size[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * size[s]
            left -= most * size[s]
        free -= over
    return size, target


def check(rows, got):
    """rows: (doc_id, text, source); got: one row per row."""
    assert Counter((i, s, words(t)) for i, t, s in rows) == Counter((r["doc_id"], r["source"], r["size"]) for r in got)
    size, target = brute_targets(rows)
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    for _, t, s in rows:
        largest[s] = max(largest[s], words(t))
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


@pytest.mark.parametrize("group", [128, 4, 2])
def test_mix(spark, group):
    sources = ["b", "a", "", None, "Ä", "hot", "hot", "hot", "tiny"]
    rows = [(i, t, sources[k % len(sources)]) for k, (i, t) in enumerate(odd_rows(long=3000) + [
        (1000 + j, "w " * (j % 50)) for j in range(600)])]
    rows.append((5000, "one", "only"))
    docs = frame(spark, [(i, t, "en", s) for i, t, s in rows], [c for c in CLASHING if c != "size"])
    first = mixing.mix(docs, group=group).collect()
    check(rows, first)
    again = mixing.mix(docs.repartition(11), group=group).collect()
    key = [(str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in first]
    assert sorted(key) == sorted((str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in again)


@pytest.mark.parametrize("n,group", [(17, 4), (65, 4), (5, 2)])
def test_sources_just_above_a_power_of_the_group(spark, n, group):
    """Their last level has few groups; every row must come out of it."""
    rows = [(i, "w " * (1 + i % 3), "a" if i < n else "b") for i in range(n + 3)]
    docs = frame(spark, [(i, t, "en", s) for i, t, s in rows])
    check(rows, mixing.mix(docs, group=group).collect())
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, group=group).collect()}
    assert sorted(plan) == list(range(n + 3))
    assert Counter(r["doc_id"] for r in mixing.take_copies(docs, group=group).collect()) == +Counter(plan)


def test_expected_copies(spark):
    """Over seeds a document's copies average its source's ratio."""
    rows = [(i, "w " * (1 + i % 7), "en", "a" if i < 30 else "b") for i in range(60)]
    docs = frame(spark, rows)
    total = Counter()
    for seed in range(12):
        for r in mixing.mix(docs, weights=(3, 1), group=4, seed=seed).collect():
            total[r["doc_id"] < 30] += r["copies"]
    _, target = brute_targets([(i, t, s) for i, t, _, s in rows], (3, 1))
    size = sum(words(t) for _, t, _, s in rows if s == "a")
    assert abs(total[True] / 12 / 30 - target["a"] / size) < 0.1


def test_copies_and_empty(spark, empty):
    docs = frame(spark, odd_rows(long=300), [c for c in CLASHING])
    out = mixing.take_copies(docs)
    assert out.columns == docs.columns
    plan = Counter()
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"], r["size"]] += r["copies"]
    got = Counter((r["doc_id"], words(r["text"])) for r in out.collect())
    assert got == +plan
    assert mixing.mix(empty).count() == 0 and mixing.take_copies(empty).count() == 0


@pytest.mark.parametrize("run", [1000, 7])
def test_ids_that_are_null_or_repeat(spark, monkeypatch, run):
    """A third of a source without ids, all texts of one size: each row is
    rounded alone, so the source ends within half a document of its target,
    and the texts taken are those of the rows."""
    monkeypatch.setattr(mixing, "RUN", run)
    rows = [(None if i % 3 == 0 else i % 100, f"w{i} " + "w " * 99, "a") for i in range(900)]
    rows += [(i, "w " * 100, "b") for i in range(700)]
    docs = frame(spark, [(i, t, "en", s) for i, t, s in rows]).repartition(5)
    mixed = mixing.mix(docs).collect()
    check(rows, mixed)
    taken = Counter(r["text"].split()[0] for r in mixing.take_copies(docs).collect() if r["source"] == "a")
    assert sum(taken.values()) == sum(r["copies"] for r in mixed if r["source"] == "a")
    low = min(r["copies"] for r in mixed if r["source"] == "a")
    assert set(taken.values()) <= {low, low + 1} - {0}


def test_whole_query(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text", "source").collect()]
    check(rows, queries.QUERIES["op5_mix_sources"](spark, SF).collect())
