from tillroll.operators import sequences as Q


def test_recommendation_blocks_padding_and_seen(spark):
    catalog = spark.createDataFrame([(i, 100 + i, i, 10) for i in range(1, 5)],
                                    "rank int, old_article_idx int, new_item_idx int, purchases bigint")
    scores = spark.createDataFrame([("s", i, float(s)) for i, s in [(0, 9.0), (1, 1.0), (2, 8.0), (3, 5.0), (4, 2.0)]],
                                   "customer_id string, new_item_idx int, score double")
    seen = spark.createDataFrame([("s", 2)], "customer_id string, new_item_idx int")
    got = Q.rank_scores(scores, catalog, 2, seen=seen).orderBy("rank").collect()
    assert [(r["rank"], r["new_item_idx"], r["old_article_idx"]) for r in got] == [(1, 3, 103), (2, 4, 104)]
    simple = Q.rank_scores_allow_seen(scores, catalog, 2).orderBy("rank").collect()
    assert [r["new_item_idx"] for r in simple] == [2, 3]


def test_k_is_clamped():
    assert Q.clamp_k(0) == 1 and Q.clamp_k(50) == 20 and Q.clamp_k(7) == 7


def test_last_n_keeps_order(spark):
    rows = [("c", None, o, 1, o, o) for o in range(30)]
    df = spark.createDataFrame(rows, "customer_id string, order_ts timestamp, order_key bigint, line_no int, "
                                     "old_article_idx int, new_item_idx int")
    seq = Q.last_n(df, 20).first()["sequence"]
    assert seq == list(range(10, 30))


def test_rank_scores_by_scorer(spark):
    catalog = spark.createDataFrame([(i, 100 + i, i, 10) for i in range(1, 5)],
                                    "rank int, old_article_idx int, new_item_idx int, purchases bigint")
    rows = [("m1", "s", 1, 0.9), ("m1", "s", 2, 0.1), ("m2", "s", 1, 0.1), ("m2", "s", 2, 0.9)]
    scores = spark.createDataFrame(rows, "scorer string, customer_id string, new_item_idx int, score double")
    got = {(r["scorer"], r["rank"]): r["new_item_idx"] for r in Q.rank_scores(scores, catalog, 1, by=["scorer"]).collect()}
    assert got == {("m1", 1): 1, ("m2", 1): 2}


CATALOG = "rank int, old_article_idx int, new_item_idx int, purchases bigint"


def test_popularity_uses_the_whole_catalogue(spark):
    """200 items, a customer who has seen the first 150: ten more follow."""
    catalog = spark.createDataFrame([(i, 1000 + i, i, 500 - i) for i in range(1, 201)], CATALOG)
    events = spark.createDataFrame([("c", None, i, 1, 1000 + i) for i in range(1, 151)] + [("new", None, 1, 1, 5)],
                                   "customer_id string, order_ts timestamp, order_key bigint, line_no int, "
                                   "old_article_idx int")
    got = Q.popularity_recommend(events, catalog, 50).collect()
    ranks = {c: sorted((r["rank"], r["new_item_idx"]) for r in got if r["customer_id"] == c) for c in ("c", "new")}
    assert ranks["c"] == [(i, 150 + i) for i in range(1, 51)]
    assert ranks["new"] == [(i, i) for i in range(1, 51)]


def test_no_cut_inside_the_operators(spark):
    catalog = spark.createDataFrame([(i, 100 + i, i, 10) for i in range(1, 61)], CATALOG)
    scores = spark.createDataFrame([("s", i, float(i)) for i in range(1, 61)],
                                   "customer_id string, new_item_idx int, score double")
    assert Q.rank_scores_allow_seen(scores, catalog, 50).count() == 50
    assert Q.rank_scores(scores, catalog, 50).count() == 50
    assert Q.answer_request(scores, catalog, 50).count() == 20


def test_blank_request_keeps_its_row(spark):
    catalog = spark.createDataFrame([(1, 7, 1, 3)], CATALOG)
    raw = spark.createDataFrame([("blank", " , ,"), ("mixed", "7, x 8"), ("empty", None)], "request_id string, raw string")
    got = {r["request_id"]: r for r in Q.encode_drop(Q.parse_requests(raw), catalog).collect()}
    assert got["blank"]["status"] == "error" and got["blank"]["unknown_article_ids"] == []
    assert got["empty"]["status"] == "error"
    assert got["mixed"]["input_article_ids"] == [7] and got["mixed"]["unknown_article_ids"] == ["x", "8"]


def test_ids_that_are_no_integers_are_unknown(spark):
    lines = spark.createDataFrame([("c", None, 1, 1, "12"), ("c", None, 2, 1, "a12")],
                                  "customer_id string, order_ts timestamp, order_key bigint, sales_channel_id int, "
                                  "article_id string")
    events = Q.sequence_lines(lines)
    catalog = Q.item_catalog(events)
    assert [r["old_article_idx"] for r in catalog.collect()] == [12]
    assert sorted(r["new_item_idx"] for r in Q.encode_zero(events, catalog).collect()) == [0, 1]


def _postings_case(spark):
    import random

    rnd = random.Random(4)
    transitions = {(i, j): rnd.choice([0.1, 0.2, 0.3]) for i in range(1, 31) for j in rnd.sample(range(1, 31), rnd.randint(0, 25))}
    t = spark.createDataFrame([(i, j, s) for (i, j), s in transitions.items()], "item int, next_item int, score double")
    catalog = spark.createDataFrame([(i, 100 + i, i, 10) for i in range(1, 31)], CATALOG)
    return rnd, transitions, t, catalog


def test_rank_successors(spark):
    """Against a sort of all unseen successors; each sequence asks for at
    most k + seen postings, and no window stands over all of them."""
    rnd, transitions, t, catalog = _postings_case(spark)
    seqs = {f"c{n}": (rnd.randint(1, 30), rnd.sample(range(1, 31), rnd.randint(1, 28))) for n in range(60)}
    df = spark.createDataFrame([(c, last, seen) for c, (last, seen) in seqs.items()],
                               "customer_id string, last_item int, seen array<int>")
    got = {}
    for r in Q.rank_successors(df, Q.postings(t), catalog, 5).collect():
        got.setdefault(r["customer_id"], []).append((r["rank"], r["new_item_idx"], r["old_article_idx"], r["score"]))
    for c, (last, seen) in seqs.items():
        best = sorted((-s, j) for (i, j), s in transitions.items() if i == last and j not in seen)[:5]
        assert sorted(got.get(c, [])) == [(n + 1, j, 100 + j, -s) for n, (s, j) in enumerate(best)]
    assert Q.rank_successors(df, Q.postings(t), catalog, 0).count() == 0


def test_last_and_seen(spark):
    rows = [("c", None, o, 1, o, 1 + o % 3) for o in range(30)] + [("d", None, 1, 1, 9, 9)]
    df = spark.createDataFrame(rows, "customer_id string, order_ts timestamp, order_key bigint, line_no int, "
                                     "old_article_idx int, new_item_idx int")
    got = {r["customer_id"]: (r["last_item"], sorted(r["seen"])) for r in Q.last_and_seen(df).collect()}
    assert got == {"c": (3, [1, 2, 3]), "d": (9, [9])}


def test_evaluation_ranks_need_one_join(spark):
    from tillroll.operators import evaluation as E

    rnd, transitions, t, _ = _postings_case(spark)
    held = [(f"c{n}", rnd.randint(1, 31), rnd.randint(1, 31)) for n in range(80)]
    ranked = E.transition_ranks(spark.createDataFrame(held, "customer_id string, target int, prev_item int"), t)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "partitionBy" not in plan.split("Window [")[0]
    for r in ranked.collect():
        order = sorted((-s, j) for (i, j), s in transitions.items() if i == r["prev_item"])
        want = next((n + 1 for n, (_, j) in enumerate(order) if j == r["target"]), None)
        assert r["target_rank"] == want
        assert r["target_score"] == transitions.get((r["prev_item"], r["target"]), E.SCORE_FLOOR)
