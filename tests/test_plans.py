"""Plan-shape checks over every registered query (scale guards)."""

from pyspark.sql import functions as F

from tillroll.operators.mining import common, levelwise
from tillroll.plans import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_plan_is_scalable(key, df):
    plan = physical_plan(df)
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op} in plan"


def test_basket_regroup_reuses_partitioning(spark):
    """Category roll-up regroups on the basket key: the only exchanges are the
    lineitem/orders join (if not broadcast) and the basket grouping."""
    plan = physical_plan(QUERIES["category_baskets_product_group"](spark, SF))
    assert plan.count("Exchange hashpartitioning(customer_id") == 1


def test_scans_are_pruned(spark):
    df = QUERIES["build_baskets"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "l_shipdate" not in text


def test_inner_plans_of_the_miners(spark):
    """The miners run their jobs inside and return a table scan, so the plans
    of their counting steps are checked here."""
    baskets = spark.createDataFrame([(f"t{i}", [f"i{j:03d}" for j in range(i % 9)]) for i in range(60)],
                                    "transaction_id string, items array<string>")
    pairs = common.basket_pairs(baskets, [], 4)
    assert_plan_is_scalable("basket_pairs", pairs.groupBy("a", "b").count())
    cand = spark.createDataFrame([(["i000", "i001"], "i002")], "prefix array<string>, ext string")
    occ = pairs.select("transaction_id", "items", F.array("a", "b").alias("itemset"))
    wide = baskets.filter(F.size("items") > 4).select("transaction_id", F.explode("items").alias("ext"))
    grown = levelwise._extended(occ, cand, wide, [])
    assert_plan_is_scalable("extended", grown.groupBy("itemset").count())
    assert grown.count() == baskets.filter(F.size("items") >= 3).count()


def test_no_frame_stays_cached(spark):
    from tillroll.session import release_tables

    spark.catalog.clearCache()
    for key in ("association_rules", "recommend_all_scorers", "topk_accuracy", "method_summary"):
        QUERIES[key](spark, SF).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
    assert release_tables(spark) > 0 and release_tables(spark) == 0
