"""Exact dedup, SimHash near-dedup and line dedup against brute force."""

import hashlib
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, ascii_lower, frame, odd_rows
from tillroll.llm import common, components, exact_dedup, line_dedup, queries, simhash

SF = "/root/testdata/sf0.001"


def brute_exact(rows):
    texts = [ascii_lower(t) for _, t in rows]
    size = Counter(texts)
    out = []
    for (i, _), t in zip(rows, texts):
        ids = [j for (j, _), u in zip(rows, texts) if u == t and j is not None]
        out.append((i, max(ids) if ids else None, size[t], hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def test_ascii_lower_equals_translate_for_every_letter(spark):
    letters = spark.createDataFrame([(c, chr(c)) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000],
                                    "code int, c string").withColumn("c", F.concat(F.lit("Zq"), "c"))
    wrong = letters.filter(common.ascii_lower(F.col("c")) != F.translate("c", common.UPPER, common.UPPER.lower()))
    assert wrong.count() == 0


@pytest.mark.parametrize("block,weak", [(4096, False), (7, False), (5, True), (1, False)])
def test_exact_dedup(spark, block, weak):
    """Also with a fingerprint of four values, so that names come from bytes."""
    rows = odd_rows(long=300)
    fp = (lambda b: F.pmod(F.xxhash64(b), F.lit(4))) if weak else exact_dedup.fingerprint64
    got = exact_dedup.exact_dedup(frame(spark, rows, CLASHING), block, fp).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute_exact(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_dedup_filter_and_empty(spark, empty):
    docs = frame(spark, odd_rows(long=300), CLASHING)
    left = exact_dedup.keep_one_of_each(docs)
    assert left.columns == docs.columns
    texts = [ascii_lower(r["text"]) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({ascii_lower(r["text"]) for r in docs.collect()})
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.keep_one_of_each(empty).count() == 0


def brute_simhash(text, words_per=4):
    import xxhash

    w = [x for x in "".join(c if c not in " \t\n\x0b\f\r" else " " for c in ascii_lower(text)).split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words_per]) for i in range(max(1, len(w) - words_per + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    least = {k: min((ids[i] for i in v if ids[i] is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("limit", [8192, 2])
def test_simhash(spark, limit):
    """A limit of 2 sends nearly all entries through the midpoint lists."""
    rows = odd_rows(long=2000)
    got = simhash.simhash_dedup(frame(spark, rows, CLASHING), entry_limit=limit).collect()
    fps = [brute_simhash(t) for _, t in rows]
    want = Counter(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], brute_components([i for i, _ in rows], fps, 4)))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


@pytest.mark.parametrize("limit,key_bytes", [(8192, 3), (3, 3), (8192, 4), (8192, 1)])
def test_near_groups_of_crafted_fingerprints(spark, limit, key_bytes):
    """Dense clusters and chains of links."""
    import random

    rng = random.Random(limit + key_bytes)
    fps = []
    for _ in range(4):
        f = rng.getrandbits(64)
        for _ in range(40):
            fps.append(f ^ sum(1 << b for b in set(rng.choices(range(64), k=rng.randint(0, 5)))))
            if rng.random() < 0.3:
                f = fps[-1]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(rows, 4, key_bytes, limit).collect()}
    assert [got[i] for i in range(len(fps))] == brute_components(list(range(len(fps))), fps, 4)


def test_simhash_filter_and_empty(spark, empty):
    docs = frame(spark, odd_rows(long=500), CLASHING)
    left = simhash.keep_one_of_group(docs)
    assert left.columns == docs.columns
    rows = docs.collect()
    groups = brute_components([r["doc_id"] for r in rows], [brute_simhash(r["text"]) for r in rows], 4)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, set(groups)))
    assert simhash.simhash_dedup(empty).count() == 0 and simhash.keep_one_of_group(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, min_lines=2):
    """Every run of two lines (blank ones aside) that came before goes."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, t in docs:
        lines = t.split("\n")
        solid = [k for k, line in enumerate(lines) if line.strip(" \t\n\x0b\f\r")]
        gone, chunks, end = set(), 0, -1
        for k in range(len(solid) - min_lines + 1):
            places = solid[k:k + min_lines]
            run = tuple(lines[p] for p in places)
            if run in seen:
                chunks += places[0] > end
                end = places[-1]
                gone.update(range(places[0], end + 1))
            seen.add(run)
        out[(i, t)] = (len(lines), chunks, len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return Counter((i, *out[(i, t or "")]) for i, t in rows)


@pytest.mark.parametrize("min_lines", [2, 3])
def test_line_dedup(spark, empty, min_lines):
    import random

    rng = random.Random(3)
    passage = [f"shared line {i} of a long passage" for i in range(14)]
    rows = [(1, None), (2, ""), (3, "one"), (4, "a\nb"), (5, "\n\n\n\n"), (6, "x\r\ny\n" * 9), (40, "a\n \nb\n\nb\nb"),
            (41, "a\nb\na\nb\n\n"), (42, "é\nß"), (43, "é\nß\nend")]
    for i in range(7, 40):
        own = [f"own {i} {j} {rng.random()}" for j in range(rng.randint(0, 12))]
        at = rng.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + passage[rng.randint(0, 3):] + own[at:])))
    got = line_dedup.line_dedup(frame(spark, rows, CLASHING), min_lines).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["removed_chunks"], r["removed_lines"], r["text"])
                   for r in got) == brute_lines(rows, min_lines)
    assert sum(r["removed_chunks"] for r in got) > 30
    same = line_dedup.line_dedup(frame(spark, [(1, "a\nb"), (1, "a\nb"), (None, "a\nb")])).collect()
    assert len(same) == 3
    assert line_dedup.line_dedup(empty).count() == 0


def test_passages_of_any_length_go_whole(spark):
    """A passage between a document's own lines goes from all but its first
    document; no own line and no single shared line goes."""
    import random

    rng = random.Random(11)
    rows, inside = [], {}
    for length in (2, 3, 4, 5, 6, 12, 40):
        passage = [f"passage {length} {j} {rng.random()}" for j in range(length)]
        for k in range(20):
            own = [f"own {length} {k} {j}" for j in range(rng.randint(2, 9))]
            at = rng.randint(1, len(own) - 1)  # own lines on both sides
            if k % 2:
                own.append("one line that many documents share")
            doc = 1000 * length + k
            rows.append((doc, "\n".join(own[:at] + passage + own[at:])))
            inside[doc] = (passage, own)
    for r in line_dedup.line_dedup(frame(spark, rows)).collect():
        passage, own = inside[r["doc_id"]]
        lines = r["text"].split("\n")
        assert [x for x in lines if x not in passage] == own
        assert len(lines) == len(own) + (0 if r["doc_id"] % 1000 else len(passage))


def test_rows_carry_their_own_lines_only(spark):
    """A long text of many lines is not copied once per line."""
    text = "\n".join(f"line {i} with some words to make it longer" for i in range(60_000))
    got = line_dedup.line_dedup(frame(spark, [(1, text), (2, "first\n" + text + "\nlast"), (3, "other")])).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: text, 2: "first\nlast", 3: "other"}


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_queries_with_sql(spark, key):
    from tools.oracle_check import digest

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    assert digest(queries.QUERIES[key](spark, SF).toPandas()) == digest(con.execute(queries.ORACLE[key]).df())


@pytest.mark.parametrize("key", ["op1_exact_dedup", "op5_mix_sources", "op6_secret_scan", "op10_line_dedup"])
def test_native_queries_run_no_python(spark, key):
    plan = queries.QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_odd_distances_in_large_entries(spark):
    """Every entry over the limit, odd and even distances, against all pairs."""
    import random

    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(8)]
    fps = {x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for x in base for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    for bits in (1, 2, 3, 4):
        group = {i: i for i in range(len(signed))}

        def root(i):
            while group[i] != i:
                i = group[i]
            return i

        for i, x in enumerate(signed):
            for j, y in enumerate(signed[:i]):
                if ((x ^ y) & (1 << 64) - 1).bit_count() <= bits:
                    a, b = sorted((root(i), root(j)))
                    group[b] = a
        for limit in (0, 8192):
            got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(rows, bits, entry_limit=limit).collect()}
            assert got == {i: root(i) for i in group}, (bits, limit)
