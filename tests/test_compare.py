from tillroll.operators import baskets as B
from tillroll.operators import compare, experiments, prep, variants

SETS = "itemset_key string, length int"


def frames(spark):
    return {"a": spark.createDataFrame([("x", 1), ("y", 1), ("x y", 2)], SETS),
            "b": spark.createDataFrame([("x", 1), ("z", 1)], SETS),
            "c": spark.createDataFrame([], SETS)}


def test_unequal_methods(spark):
    found = frames(spark)
    long = compare.method_long(found)
    assert compare.common_itemsets(long, ["a", "b"]).first()[0] == 1
    assert compare.common_itemsets(long, list(found)).first()[0] == 0
    got = {r["pair"]: (r["only_left"], r["only_right"], r["total_difference"])
           for r in compare.pairwise_differences(long, list(found)).collect()}
    assert got == {"a_vs_b": (2, 1, 3), "a_vs_c": (3, 0, 3), "b_vs_c": (2, 0, 2)}


def test_agreement_false_and_true(spark):
    stats = spark.createDataFrame([(9, 4)], "transactions bigint, unique_items bigint")
    found = frames(spark)
    summary = experiments.method_summary(found, stats, {"a": 2.0, "b": 1.0, "c": 1.0})
    rows = {r["algorithm"]: (r["frequent_itemsets"], r["max_itemset_length"], r["fastest"]) for r in summary.collect()}
    assert rows == {"a": (3, 2, False), "b": (2, 1, True), "c": (0, 0, False)}
    assert compare.method_agreement(summary).first()["all_agree"] is False
    same = experiments.method_summary({"a": found["a"], "d": found["a"]}, stats)
    assert compare.method_agreement(same).first()["all_agree"] is True


def test_first_rows_and_restrict(spark):
    rows = [(f"t{i}", f"c{i % 3}", f"1996-01-{i % 28 + 1:02d}", ["a", "b", "b"] if i % 2 else ["z"]) for i in range(40)]
    baskets = spark.createDataFrame(rows, "transaction_id string, customer_id string, t_dat string, items array<string>")
    first = B.first_n(baskets.repartition(7), 11).collect()
    assert sorted((r["t_dat"], r["customer_id"]) for r in first) == sorted((d, c) for _, c, d, _ in rows)[:11]
    allowed = spark.createDataFrame([("b", 9), ("a", 3)], "item string, frequency bigint")
    got = {r["transaction_id"]: r["items"] for r in B.restrict_items(baskets, allowed).collect()}
    assert got["t1"] == ["a", "b"] and got["t2"] == [] and len(got) == 40
    assert prep.first_rows(baskets, 0, ["t_dat"]).count() == 0


def test_years_outside_the_default_ranges(spark):
    baskets = spark.createDataFrame([("t", "c", "2018-05-01", ["a", "b"], 2)],
                                    "transaction_id string, customer_id string, t_dat string, items array<string>, "
                                    "item_count int")
    articles = spark.createDataFrame([("a", "G", "G", "S")],
                                     "article_id string, product_group_name string, garment_group_name string, "
                                     "section_name string")
    customers = spark.createDataFrame([("c", None)], "customer_id string, age double")
    ranges = variants.year_ranges(baskets)
    assert ranges == [("year_2018", "2018-01-01", "2018-12-31")]
    got = variants.all_variants(baskets, articles, customers, ranges=ranges)
    assert [r["variant"] for r in got.collect()] == ["year_2018"]
