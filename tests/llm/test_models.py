"""Language ID, quality scores, nearest neighbours, and the pipeline."""

import math
import zlib

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, frame, odd_rows
from tillroll.llm import ann, gru, langid, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("lengths", [None, np.array([6, 1, 4, 6, 3])])
def test_gradients(lengths):
    net = gru.Network(3, 4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    text, label = rng.integers(97, 105, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = net.gradients(text, label, lengths)
    for k, v in net.w.items():
        at = (int(text[0, 2]), 3) if k.startswith("in") else tuple(rng.integers(0, n) for n in v.shape)
        v[at] += 1e-3
        up = net.gradients(text, label, lengths)[0]
        v[at] -= 2e-3
        down = net.gradients(text, label, lengths)[0]
        v[at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[k][at]) < 1e-5


def plain(net, text: bytes):
    """Mean label probabilities of one pass over the whole text, uncut."""
    return net.position_probs(np.frombuffer(text, np.uint8)[None])[:, 0].mean(axis=0)


def test_windows():
    texts = [b"", b"a", b"word " * 500, "é".encode() * 1000, "日本語".encode() * 300, "a😀".encode() * 200, b"x" * 5000]
    for t in texts:
        cut = langid.windows(t)
        assert b"".join(t[b:c] for _, b, c, _ in cut) == t
        for a, b, c, d in cut:
            t[a:b].decode(), t[b:c].decode(), t[c:d].decode()  # cut at character starts
            assert b < c and d - a <= langid.CORE + 2 * langid.CONTEXT + 9
            assert a == 0 or b - a >= langid.CONTEXT
            assert d == len(t) or d - c >= langid.CONTEXT - 3


def test_pooling_equals_a_plain_pass():
    """Strings of one window: the states, whatever runs beside them."""
    net = gru.Network(3, 4)
    texts = [b"one two three two", b"", "é à ü 日本".encode(), b"x" * langid.CORE, b"a", b"\n\n \t"]
    for group in (texts, texts[:1], texts * 200):
        for t, row in zip(group, langid.pooled(net, group)):
            assert np.allclose(row, plain(net, t) if t else 0, atol=1e-5)


def test_pooled_sums_equal_the_probabilities_of_positions():
    """Rows of several products, of any length, read from any offset, also with states at their limits."""
    rng = np.random.default_rng(3)
    net = gru.Network(3, 4)
    strings = [rng.integers(97, 123, rng.integers(1, 60)).astype(np.uint8).tobytes() for _ in range(600)]
    lengths = np.array([len(s) for s in strings])
    first = rng.integers(0, lengths)
    last = rng.integers(first + 1, lengths + 1)
    for scale in (1, 50):
        net.w = {k: v * np.float32(scale) for k, v in net.w.items()}
        for few in (1, 257, 600):
            text, _ = gru.padded(strings[:few])
            got = net.pooled(text, lengths[:few], first[:few], last[:few])
            assert got.shape == (few, 3) and np.isfinite(got).all()
            probs = net.position_probs(text, lengths[:few])
            want = [probs[a:b, i].sum(axis=0) for i, (a, b) in enumerate(zip(first[:few], last[:few]))]
            if scale == 1:
                assert np.allclose(got, want, atol=1e-4)
            assert np.allclose(got.sum(axis=1), last[:few] - first[:few], atol=1e-3)


def test_pooling_reads_little_more_than_the_texts(monkeypatch):
    """a direction reads the context before its windows, not that behind, in few steps of many windows."""
    reads, steps, take = [], [], np.take

    def counted(table, indices, **how):
        reads.append(indices.size)
        steps.append(1)
        return take(table, indices, **how)

    texts = [b"some words and more " * n for n in range(40, 440)]
    monkeypatch.setattr(np, "take", counted)
    langid.pooled(gru.Network(4), texts)
    size = sum(map(len, texts))
    assert 2 * size <= sum(reads) < 2 * 1.25 * size
    assert sum(reads) / len(steps) > 700


def test_windows_agree_with_a_plain_pass_over_whole_texts(spark):
    docs = queries.table(spark, SF, "documents")
    languages, net = langid.fit(docs)
    texts = [r["text"].encode() for r in docs.filter("text is not null and text <> ''").collect()]
    texts = [t for t in texts if len(t) < 40_000]
    got, want = langid.pooled(net, texts), np.array([plain(net, t) for t in texts])
    assert sum(len(t) > 4 * langid.CORE for t in texts) > 20
    assert (got.argmax(axis=1) == want.argmax(axis=1)).mean() >= 0.99
    # repetitions of a word or of signs, where no language is clear, may differ by more
    off = np.abs(got - want).max(axis=1)
    assert np.quantile(off, 0.95) < 0.05 and off.mean() < 0.01


def test_language_query_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_language_id"](spark, SF).collect()}
    docs = queries.table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    right = held = 0
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        held += r["held_out"]
        right += r["held_out"] and r["lang_pred"] == d["lang"]
    assert right / held >= 0.95


def test_language_odd_rows(spark, empty):
    docs = frame(spark, odd_rows(long=2000), CLASHING)
    got = {}
    for r in langid.identify(docs, steps=20).collect():
        got.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert got[1] == got[2] == got[3] == got[12] == ["und"]
    assert got[13] == ["en"] and got[9] == ["en"] * 3 and sum(map(len, got.values())) == docs.count()
    kept = langid.keep_identified(docs, steps=20)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    assert langid.identify(empty).count() == 0 and langid.keep_identified(empty).count() == 0


def brute_quality(rows, labels, threshold=0.5):
    """The operator's formulas in numpy; rows: (id, text, host, path)."""
    x = np.array([quality.text_features((t or "").encode()) for _, t, _, _ in rows])
    y = np.array([labels.get(i, np.nan) for i, *_ in rows])
    known = ~np.isnan(y)
    b, w, mean, scale, base = quality.fit_logistic(x[known], y[known])
    evidence = b + np.clip((x - mean) / scale, -8, 8) @ w - math.log(base / (1 - base))
    p = 1 / (1 + np.exp(-(evidence + math.log(base / (1 - base)))))
    share = np.where(known, y, p)
    host, path = [r[2] for r in rows], [(r[2], r[3]) for r in rows]

    def sums(keys):
        out = {}
        for k, s in zip(keys, share):
            a, n = out.get(k, (0.0, 0))
            out[k] = (a + s, n + 1)
        return out

    def moments(groups, towards):
        spread = sum(n * (s / n - towards(k)) ** 2 for k, (s, n) in groups.items())
        m = {k: towards(k) * (1 - towards(k)) for k in groups}
        chance, mass = sum(m.values()), sum(n * m[k] for k, (_, n) in groups.items())
        part = max(0.0, (spread - chance) / max(mass - chance, 1e-12))
        return min(1e6, max(1.0, 1 / part - 1)) if part > 0 else 1e6

    hosts, paths, rate = sums(host), sums(path), share.mean()
    k_host = moments(hosts, lambda _: rate)
    mean_of = {k: (s + k_host * rate) / (n + k_host) for k, (s, n) in hosts.items()}
    k_path = moments(paths, lambda k: mean_of[k[0]])
    out = []
    for i, (r, e, s) in enumerate(zip(rows, evidence, share)):
        a, n = hosts[r[2]]
        q_host = (a - s + k_host * rate) / (n - 1 + k_host)
        a, n = paths[(r[2], r[3])]
        q = (a - s + k_path * q_host) / (n - 1 + k_path)
        q = min(max(q, 1e-4), 1 - 1e-4)
        out.append(1 / (1 + math.exp(-(e + math.log(q / (1 - q))))))
    return out


def test_quality_equals_numpy(spark):
    docs = queries.table(spark, SF, "documents")
    labels = queries.table(spark, SF, "labels")
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_quality"](spark, SF).collect()}
    rows = [(r["doc_id"], r["text"], r["source"], f"{r['source']}/{r['lang']}") for r in docs.collect()]
    want = brute_quality(rows, {r["doc_id"]: r["quality"] for r in labels.collect()})
    assert len(got) == len(rows)
    assert np.allclose([got[r[0]]["score"] for r in rows], want, atol=1e-6)


def test_quality_separates_held_out_labels(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    learn = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0)
    got = quality.score(docs, learn, docs["source"], F.concat_ws("/", "source", "lang"))
    rows = got.join(labels.join(learn, "doc_id", "left_anti"), "doc_id").select("score", "quality").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.9


def test_quality_odd_rows(spark, empty):
    docs = frame(spark, odd_rows(long=500), CLASHING)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score(docs, none, docs["source"], docs["lang"]).collect()
    assert len(got) == docs.count() and all(0 < r["score"] < 1 for r in got)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20, 50)] + [(20, None, 0), (None, 1, 0), (21, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    nulls = quality.score(docs, labels, F.lit(None), F.lit(None)).collect()
    assert len(nulls) == docs.count()
    assert quality.score(empty, labels, F.col("source"), F.col("lang")).count() == 0


def test_sparse_sites_shrink(spark):
    """A path with one bad document stays near its host, a large one does not."""
    rows = [(i, "the same words", "en", "good") for i in range(200)] + [(500, "the same words", "fr", "good")]
    rows += [(1000 + i, "the same words", "en", "bad") for i in range(200)]
    labels = [(i, 1, 0) for i in range(200)] + [(500, 0, 0)] + [(1000 + i, 0, 0) for i in range(200)]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in quality.score(
        docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs["source"],
        F.concat_ws("/", "source", "lang")).collect()}
    assert got[3]["score"] > 0.8 and got[1003]["score"] < 0.2 and got[500]["path_rate"] > 0.5


def brute_nearest(vectors, k):
    out = {}
    for q in vectors:
        if q % 20 == 0:
            s = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            out[q] = s[:k]
    return out


@pytest.mark.parametrize("k", [20, 1000])
def test_nearest_with_odd_vectors(spark, k):
    rng = np.random.default_rng(1)
    base = [rng.normal(size=5).round(1).tolist() for _ in range(20)]
    rows = [(i, base[i % 20] if i % 3 else rng.normal(size=5).tolist()) for i in range(300)]
    odd = [(300, None), (301, [0.0] * 5), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5),
           (304, [float("inf")] * 5), (305, [1.0, 2.0])]
    # rows of their own: repeated ids with the same and other vectors, also of a query, and rows without id
    rows += [(40, rows[40][1]), (60, rng.normal(size=5).tolist()), (5, [90.0] * 5), (5, rows[5][1]), (None, [80.0] * 5),
             (None, rows[7][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("code", F.lit("x"))
    index = ann.build_index(ann.valid_vectors(table.withColumn("row", F.lit("x"))))
    got = ann.search(index, index.rows.filter("vec_id % 20 = 0"), k=k, scan_rows=37, query_rows=6).collect()
    m = np.array([v for _, v in rows])
    mine, want = Counter(), Counter()
    for r in got:
        mine[r["query_id"], r["rank"], round(r["score"], 9)] += 1
    for q, (i, v) in enumerate(rows):
        if i is not None and i % 20 == 0:
            scores = np.delete(m @ m[q], q)
            want.update((i, n + 1, round(s, 9)) for n, s in enumerate(np.sort(scores)[::-1][:k].tolist()))
    assert mine == want
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(np.array(v))
    for r in got:  # the score is one of the named vector's, and ties are in order of the ids
        assert any(abs(v @ u - r["score"]) < 1e-9 for v in vectors[r["vec_id"]] for u in vectors[r["query_id"]])
    once = [i for i in vectors if i is not None and i % 20 == 0 and len(vectors[i]) == 1]
    for q in once:
        order = [(-round(r["score"], 9), r["vec_id"] is None, r["vec_id"] or 0)
                 for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert order == sorted(order) and q not in {r["vec_id"] for r in got if r["query_id"] == q}


def test_nearest_recall_and_empty(spark):
    got = queries.QUERIES["op8_nearest_neighbours"](spark, SF).toPandas()
    v = queries.table(spark, SF, "embeddings").toPandas().set_index("vec_id").embedding
    m = np.array(v.tolist(), dtype=np.float64)
    hits = total = 0
    for q in v.index[v.index % 20 == 0]:
        s = m @ m[v.index.get_loc(q)]
        s[v.index.get_loc(q)] = -np.inf
        best = set(v.index[np.lexsort((v.index, -s))[:20]])
        hits += len(best & set(got[got.query_id == q].vec_id))
        total += 20
    assert hits / total >= 0.9
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.build_index(ann.valid_vectors(none)) is None and ann.search(None, none).count() == 0


def test_pipeline(spark, tmp_path, empty):
    import corpus_pipeline
    from tests.llm.test_dedup import brute_components, brute_simhash
    from tests.llm.helpers import ascii_lower
    from tests.llm.test_tokens import check_pack
    from tokenizers import Tokenizer

    rows = [(i, t, "en", f"s{k % 4}") for k, (i, t) in enumerate(odd_rows(long=3000))]
    docs, seen = frame(spark, rows), []
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    cur = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, cur, f"file://{tmp_path}")
        out.write.parquet(f"file://{tmp_path}/{name}")
        cur = spark.read.parquet(f"file://{tmp_path}/{name}")
        seen.append(cur.collect())
        if name != "best_fit_packing":
            assert cur.columns == docs.columns
    language, exact, near, mixed, packed = seen
    assert all(any(c.isalpha() for c in r["text"] or "") for r in language) and len(language) == len(rows) - 5
    texts = {ascii_lower(r["text"]): r["doc_id"] for r in sorted(language, key=lambda r: (r["doc_id"] or -1))}
    assert sorted(map(str, texts.values())) == sorted(str(r["doc_id"]) for r in exact)
    groups = brute_components([r["doc_id"] for r in exact], [brute_simhash(r["text"]) for r in exact], 4)
    assert sorted(map(str, set(groups))) == sorted(str(r["doc_id"]) for r in near)
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in near} and len(mixed) > 0
    tok = Tokenizer.from_file(queries.vocabulary())
    check_pack([(r["doc_id"], r["text"]) for r in mixed], packed, tok, 4096)
    same = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert same.count() == len(packed)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
