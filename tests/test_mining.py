import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import mining, rules as R


def baskets_df(spark, baskets, group=None):
    rows = [(f"t{i}", b) for i, b in enumerate(baskets)]
    df = spark.createDataFrame(rows, "transaction_id string, items array<string>")
    return df


def brute(baskets, min_support, max_len):
    sets = [set(b) for b in baskets]
    n = len(sets)
    thr = math.ceil(min_support * n)
    items = sorted(set().union(*sets)) if sets else []
    out = {}
    for k in range(1, max_len + 1):
        found = False
        for combo in itertools.combinations(items, k):
            c = sum(1 for s in sets if set(combo) <= s)
            if c >= thr and c > 0:
                out[" ".join(combo)] = c
                found = True
        if not found:
            break
    return out


def as_dict(df):
    return {r["itemset_key"]: r["support_count"] for r in df.collect()}


THREE = [["a", "b", "c"], ["a", "b", "c"], ["a", "b"]]


@pytest.mark.parametrize("method", ["apriori", "fpgrowth", "eclat"])
def test_three_baskets(spark, method):
    got = as_dict(mining.mine(baskets_df(spark, THREE), 0.2, 3, method))
    assert got == {"a": 3, "b": 3, "c": 2, "a b": 3, "a c": 2, "b c": 2, "a b c": 2}


def test_rules_any_consequent_size(spark):
    found = mining.apriori(baskets_df(spark, THREE), 0.2, 3)
    rules = R.association_rules(found, 0.0).collect()
    assert len(rules) == 12
    assert sum(1 for r in rules if len(r["consequent_items"]) == 2) == 3
    ab_c = [r for r in rules if r["antecedents"] == "a b" and r["consequents"] == "c"][0]
    assert ab_c["confidence"] == pytest.approx(2 / 3)
    assert ab_c["lift"] == pytest.approx((2 / 3) / (2 / 3))
    assert ab_c["conviction"] == pytest.approx((1 - 2 / 3) / (1 - 2 / 3))
    a_b = [r for r in rules if r["antecedents"] == "a" and r["consequents"] == "b"][0]
    assert a_b["conviction"] == float("inf")


def test_threshold_edge(spark):
    baskets = [["a", "z"] for _ in range(7)] + [["y", "z"] for _ in range(93)]
    got = as_dict(mining.apriori(baskets_df(spark, baskets), 0.07, 1))
    assert "a" not in got  # ceil(0.07 * 100) == 8 in double arithmetic
    assert got["z"] == 100


def test_empty_result_keeps_schema(spark):
    out = mining.apriori(baskets_df(spark, [["a", "b"], ["c", "d"]]), 1.0, 3)
    assert out.count() == 0
    assert out.columns == ["items", "itemset_key", "length", "support_count", "support"]
    rules = R.association_rules(out, 0.5)
    assert rules.count() == 0 and "confidence" in rules.columns


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_methods_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    alphabet = list("abcdefgh")
    baskets = [rnd.sample(alphabet, rnd.randint(1, 6)) for _ in range(60)]
    expected = brute(baskets, 0.15, 4)
    df = baskets_df(spark, baskets)
    for method in ("apriori", "fpgrowth", "eclat"):
        assert as_dict(mining.mine(df, 0.15, 4, method)) == expected, method
    # wide-basket path (every basket counted through the distributed join)
    assert as_dict(mining.apriori(df, 0.15, 4, wide_width=1)) == expected
    # several tid-list buckets per item
    assert as_dict(mining.eclat(df, 0.15, 4, buckets=5)) == expected


def test_grouped_mining_equals_per_group(spark):
    rnd = random.Random(7)
    rows = []
    per = {}
    for g in ("g1", "g2"):
        bs = [rnd.sample(list("abcdef"), rnd.randint(1, 5)) for _ in range(40)]
        per[g] = brute(bs, 0.2, 3)
        rows += [(g, f"{g}-{i}", b) for i, b in enumerate(bs)]
    df = spark.createDataFrame(rows, "variant string, transaction_id string, items array<string>")
    for method in ("apriori", "eclat"):
        got = mining.mine(df, 0.2, 3, method, group_cols=["variant"]).collect()
        for g in per:
            assert {r["itemset_key"]: r["support_count"] for r in got if r["variant"] == g} == per[g]


def test_repeated_ids_are_baskets_of_their_own(spark):
    """A row is a basket: ids that repeat or are missing change nothing."""
    baskets = [["a", "b", "b"], ["a", "b"], ["a", "c", "b"], ["b", "c", "a"], ["c", "b"], ["a"], ["c", "d"]]
    ids = ["t1", "t1", "t1", "t1", "t5", None, None]
    df = spark.createDataFrame(list(zip(ids, baskets)), "transaction_id string, items array<string>")
    want = brute(baskets, 0.1, 3)
    for method in ("apriori", "fpgrowth", "eclat"):
        assert as_dict(mining.mine(df, 0.1, 3, method)) == want, method
        grouped = mining.mine(df.withColumn("v", F.lit("x")), 0.1, 3, method, group_cols=["v"])
        assert as_dict(grouped) == want and {r["v"] for r in grouped.collect()} == {"x"}
    assert as_dict(mining.apriori(df, 0.1, 3, wide_width=1)) == want


@pytest.mark.parametrize("wide_width", [64, 3])
def test_candidates_beyond_the_broadcast_limit(spark, wide_width):
    """The partitioned trie counts what the broadcast candidates count."""
    rnd = random.Random(5)
    alphabet = [f"i{j}" for j in range(12)]
    baskets = [sorted({rnd.choice(alphabet[:rnd.randint(2, 12)]) for _ in range(rnd.randint(1, 9))}) for _ in range(150)]
    df = baskets_df(spark, baskets)
    want = brute(baskets, 0.04, 5)
    assert max(len(k.split()) for k in want) >= 4
    assert as_dict(mining.apriori(df, 0.04, 5, wide_width=wide_width, broadcast_rows=0)) == want
    two = df.withColumn("v", F.lit("x")).unionByName(df.withColumn("v", F.lit("y")))
    got = mining.apriori(two, 0.04, 4, ["v"], wide_width, broadcast_rows=0).collect()
    for v in ("x", "y"):
        assert {r["itemset_key"]: r["support_count"] for r in got if r["v"] == v} == {
            k: c for k, c in want.items() if len(k.split()) <= 4}


def test_the_trie_walk_moves_no_occurrences(spark):
    """Only baskets by first item, trie nodes and partial counts are shuffled;
    a hot first item is dealt over several salts."""
    from tillroll.operators.mining import trie

    baskets = [[f"i{j}" for j in range(8) if (i >> j) & 1] for i in range(256)]
    trimmed = spark.createDataFrame([(i, b) for i, b in enumerate(baskets) if len(b) > 1],
                                    "transaction_id long, items array<string>")
    combos = list(itertools.combinations([f"i{j}" for j in range(8)], 4))
    cand = spark.createDataFrame([(list(c[:-1]), c[-1]) for c in combos], "prefix array<string>, ext string")
    l1 = spark.createDataFrame([(f"i{j}", 128) for j in range(8)], "item string, support_count long")
    occ = trie.routed(trimmed, trimmed.filter("false"), cand, l1, 4, None, [], routes=50)
    with trie.co_partitioned(spark):
        counts = occ.groupBy("itemset").count()
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r["itemset"]): r["count"] for r in counts.collect()} == {c: 16 for c in combos}
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # baskets, inner nodes and leaves by (first, salt); no side of the walk once more by its node
    assert sum("REPARTITION_BY_NUM" in m and "first" in m and "salt" in m for m in moved) == 3
    assert not any("transaction_id" in m or "first" in m and "node" in m for m in moved)


def test_fpgrowth_forms_nothing_longer_than_asked(spark):
    """Twenty items in every basket: 2^20 itemsets if the length were not
    bounded."""
    items = [f"i{j:02d}" for j in range(20)]
    df = baskets_df(spark, [items] * 30)
    got = as_dict(mining.fpgrowth(df, 0.5, 2))
    assert got == {" ".join(c): 30 for k in (1, 2) for c in itertools.combinations(items, k)}


def test_fpgrowth_long_paths(spark):
    from tillroll.operators.mining.fpgrowth import projected

    rows = spark.createDataFrame([([], [f"i{j}" for j in range(10)], 3), ([], ["i1"], 2)],
                                 "itemset array<string>, path array<string>, n long")
    whole = sorted((tuple(r["itemset"]), tuple(r["path"]), r["n"]) for r in projected(rows, []).collect())
    parts = sorted((tuple(r["itemset"]), tuple(r["path"]), r["n"]) for r in projected(rows, [], block=3).collect())
    assert whole == parts and len(whole) == 9


def test_eclat_ships_a_chunk_once_per_class(spark):
    from tillroll.operators.mining import vertical

    chunks = spark.createDataFrame([(["a"], f"x{j}", 0, [2**j - 1, 7]) for j in range(1, 7)],
                                   "class array<string>, last string, chunk long, bits array<long>")
    cand = spark.createDataFrame([(["a", f"x{i}"], f"x{j}") for i in range(1, 7) for j in range(i + 1, 7)],
                                 "prefix array<string>, ext string")
    grown = vertical.joined_chunks(vertical.classes(chunks, []), vertical.candidates_by_class(cand, 3, []), [])
    got = {(r["class"][1], r["last"]): r["bits"] for r in grown.collect()}
    assert got == {(f"x{i}", f"x{j}"): [2**i - 1, 7] for i in range(1, 7) for j in range(i + 1, 7)}
    plan = grown._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("last" in m for m in moved)


def test_argument_checks(spark):
    df = baskets_df(spark, THREE)
    with pytest.raises(ValueError):
        mining.mine(df, 0.0, 3)
    with pytest.raises(ValueError):
        mining.mine(df, 0.5, 0)
    with pytest.raises(ValueError):
        mining.mine(df, 0.5, 3, "nope")


@pytest.mark.parametrize("seed", [11, 12])
def test_rules_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    baskets = [rnd.sample(list("abcdefg"), rnd.randint(1, 5)) for _ in range(50)]
    n = len(baskets)
    counts = brute(baskets, 0.1, 4)
    expected = {}
    for key, c in counts.items():
        items = key.split(" ")
        for r in range(1, len(items)):
            for ant in itertools.combinations(items, r):
                con = [x for x in items if x not in ant]
                s_ac, s_a, s_c = c / n, counts[" ".join(ant)] / n, counts[" ".join(con)] / n
                conf = s_ac / s_a
                if conf >= 0.3:
                    expected[(" ".join(ant), " ".join(con))] = (conf, conf / s_c)
    found = mining.apriori(baskets_df(spark, baskets), 0.1, 4)
    got = {(r["antecedents"], r["consequents"]): (r["confidence"], r["lift"])
           for r in R.association_rules(found, 0.3).collect()}
    assert set(got) == set(expected)
    for k, (conf, lift) in expected.items():
        assert got[k][0] == pytest.approx(conf) and got[k][1] == pytest.approx(lift)


def test_equal_baskets_are_one_row(spark):
    """Baskets that are equal once trimmed are counted as one row, alike by
    the short list inside the row and by the join."""
    from tillroll.operators.mining import common

    rows = [(i, ["a", "b", "c", f"rare{i:03d}"]) for i in range(300)] + [(300 + i, ["a", "c"]) for i in range(100)]
    b = spark.createDataFrame(rows, "transaction_id long, items array<string>")
    frequent = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "item string")
    for known in (4, common.IN_ROW + 1):
        trimmed = common.trim_baskets(b, frequent, known, True, [])
        assert ("hashpartitioning" in trimmed._jdf.queryExecution().executedPlan().toString()) == (known > common.IN_ROW)
        got = common.merge_equal(trimmed, []).collect()
        assert sorted((r["items"], r["transaction_id"]["n"]) for r in got) == [(["a", "b", "c"], 300), (["a", "c"], 100)]
