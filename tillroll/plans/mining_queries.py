"""Queries for frequent itemsets (M), method comparison (C) and the
benchmark tables (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import baskets as B
from tillroll.operators import compare, experiments, mining, patterns, prep
from tillroll.operators import itemsets as IS
from tillroll.operators import rules as R
from tillroll.plans import sql as S
from tillroll.plans.inputs import (
    article_names, basket_arrays, garment_baskets, mining_baskets, product_group_baskets,
)
from tillroll.plans.registry import query
from tillroll.session import cut_lineage, held

MIN_SUPPORT = 0.005
MAX_LEN = 3
ITEMSET_OUT = ["itemset_key", "length", "support_count", "support"]

_ITEMSETS_SQL = S.mining_with(*S.itemsets_upto3(MIN_SUPPORT))


def _out(df):
    return df.select(*ITEMSET_OUT)


@query("frequent_items", S.mining_with(*S.itemsets_upto3(MIN_SUPPORT, max_len=1)) + "SELECT itemset_key, length, support_count, support FROM itemsets")
def frequent_items(spark, sf_dir):
    return _out(mining.frequent_items(mining_baskets(spark, sf_dir), MIN_SUPPORT))


@query("apriori_itemsets", _ITEMSETS_SQL + "SELECT itemset_key, length, support_count, support FROM itemsets")
def apriori_itemsets(spark, sf_dir):
    return _out(mining.apriori(mining_baskets(spark, sf_dir), MIN_SUPPORT, MAX_LEN))


@query("fpgrowth_itemsets", _ITEMSETS_SQL + "SELECT itemset_key, length, support_count, support FROM itemsets")
def fpgrowth_itemsets(spark, sf_dir):
    return _out(mining.fpgrowth(mining_baskets(spark, sf_dir), MIN_SUPPORT, MAX_LEN))


@query("eclat_itemsets", _ITEMSETS_SQL + "SELECT itemset_key, length, support_count, support FROM itemsets")
def eclat_itemsets(spark, sf_dir):
    return _out(mining.eclat(mining_baskets(spark, sf_dir), MIN_SUPPORT, MAX_LEN))


# -- itemset post-processing -------------------------------------------------

ARTICLE_SUPPORT, ARTICLE_MAX_LEN = 0.002, 2
MIN_ITEMSET_LENGTH = 2
TOP_RESULTS = 20
CARD_TOP = 40
RULE_SUPPORT, RULE_MAX_LEN, MIN_CONFIDENCE = 0.02, 4, 0.2


def _main_itemsets(spark, sf_dir):
    return mining.apriori(mining_baskets(spark, sf_dir), MIN_SUPPORT, MAX_LEN)


_ARTICLE_CTES = ["art_baskets AS (SELECT transaction_id, items FROM baskets)",
                 "art_items AS (SELECT transaction_id, unnest(items) AS item FROM art_baskets)"]


@query("itemsets_with_names", S.with_(S.TX, S.ARTICLES, S.BASKETS, *_ARTICLE_CTES,
                                      *S.itemsets_sql(ARTICLE_SUPPORT, ARTICLE_MAX_LEN, "art_items", "art_baskets"),
                                      f"names AS (SELECT {S.zfill('article_id')} AS article_id, prod_name FROM articles)")
       + """
SELECT i.itemset_key, i.length, i.support_count, i.support, n.product_names
FROM itemsets i JOIN (
  SELECT itemset_key, string_agg(coalesce(nm.prod_name, u.item), ' | ' ORDER BY u.pos) AS product_names
  FROM (SELECT itemset_key, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS pos FROM itemsets) u
  LEFT JOIN names nm ON nm.article_id = u.item GROUP BY itemset_key) n USING (itemset_key)""")
def itemsets_with_names(spark, sf_dir):
    arts = B.min_items_filter(basket_arrays(spark, sf_dir).select("transaction_id", "items"), 2)
    found = mining.apriori(arts, ARTICLE_SUPPORT, ARTICLE_MAX_LEN)
    return IS.with_product_names(found, article_names(spark, sf_dir)).select(*ITEMSET_OUT, "product_names")


@query("itemsets_min_length", _ITEMSETS_SQL + f"SELECT itemset_key, length, support_count, support FROM itemsets WHERE length >= {MIN_ITEMSET_LENGTH}")
def itemsets_min_length(spark, sf_dir):
    return _out(IS.min_length(_main_itemsets(spark, sf_dir), MIN_ITEMSET_LENGTH))


@query("top_itemsets", _ITEMSETS_SQL + f"""SELECT itemset_key, length, support_count, support FROM itemsets WHERE length >= 1
ORDER BY support DESC, length DESC, itemset_key LIMIT {TOP_RESULTS}""")
def top_itemsets(spark, sf_dir):
    return _out(IS.top_itemsets(_main_itemsets(spark, sf_dir), 1, TOP_RESULTS))


@query("combo_cards", _ITEMSETS_SQL + f"""
SELECT CAST(position AS INTEGER) AS position, itemset_key, length, support_count, support FROM (
  SELECT *, row_number() OVER (ORDER BY support DESC, length DESC, itemset_key) AS position FROM (
    SELECT * FROM itemsets ORDER BY support DESC, length DESC, itemset_key LIMIT {CARD_TOP}))
WHERE length >= 2 ORDER BY position LIMIT 6""")
def combo_cards(spark, sf_dir):
    return IS.combo_cards(_main_itemsets(spark, sf_dir), 1, CARD_TOP).withColumn(
        "position", F.col("position").cast("int"))


# -- comparison of methods ---------------------------------------------------

# the methods on the same baskets: with equal parameters, and each with its own
EQUAL = {m: (MIN_SUPPORT, MAX_LEN) for m in ("apriori", "fpgrowth", "eclat")}
OWN = {"apriori": (MIN_SUPPORT, MAX_LEN), "fpgrowth": (MIN_SUPPORT, 2), "eclat": (2 * MIN_SUPPORT, MAX_LEN)}
_OWN_SQL = S.mining_with(*[cte for m, (support, length) in OWN.items()
                           for cte in S.itemsets_sql(support, length, name=f"own_{m}")])


def _mined(tx, settings):
    return {m: mining.mine(tx, support, length, m) for m, (support, length) in settings.items()}


def _own(spark, sf_dir):
    with held(mining_baskets(spark, sf_dir)) as tx:
        return _mined(tx, OWN)


@query("common_itemsets", _OWN_SQL + "SELECT count(*) AS common_itemsets FROM ("
       + " INTERSECT ".join(f"SELECT itemset_key FROM own_{m}" for m in OWN) + ")")
def common_itemsets(spark, sf_dir):
    res = _own(spark, sf_dir)
    return compare.common_itemsets(compare.method_long(res), list(res))


_PAIRS = [("apriori", "eclat"), ("apriori", "fpgrowth"), ("eclat", "fpgrowth")]


def _only(left: str, right: str) -> str:
    return f"(SELECT count(*) FROM (SELECT itemset_key FROM own_{left} EXCEPT SELECT itemset_key FROM own_{right}))"


@query("pairwise_differences", _OWN_SQL + " UNION ALL ".join(
    f"SELECT '{l}_vs_{r}' AS pair, '{l}' AS left_method, '{r}' AS right_method, {_only(l, r)} AS only_left, "
    f"{_only(r, l)} AS only_right, {_only(l, r)} + {_only(r, l)} AS total_difference" for l, r in _PAIRS))
def pairwise_differences(spark, sf_dir):
    res = _own(spark, sf_dir)
    return compare.pairwise_differences(compare.method_long(res), list(res))


_STATS_SQL = """stats AS (SELECT (SELECT count(*) FROM mining_baskets) AS transactions,
                        (SELECT count(DISTINCT item) FROM mining_items) AS unique_items)"""


@query("method_summary", S.mining_with(*S.itemsets_sql(MIN_SUPPORT, MAX_LEN), _STATS_SQL) + " UNION ALL ".join(
    f"SELECT '{m}' AS algorithm, (SELECT count(*) FROM itemsets) AS frequent_itemsets, "
    f"(SELECT coalesce(max(length), 0) FROM itemsets) AS max_itemset_length, transactions, unique_items FROM stats"
    for m in ("apriori", "fpgrowth", "eclat")))
def method_summary(spark, sf_dir):
    with held(mining_baskets(spark, sf_dir)) as tx:
        results, _ = experiments.run_methods(tx, MIN_SUPPORT, MAX_LEN)
        return cut_lineage(experiments.method_summary(results, B.basket_stats(tx)))


_AGREE_SQL = """SELECT '{run}' AS run, count(*) AS methods, count(DISTINCT n) = 1 AS all_agree, min(n) AS min_itemsets,
  max(n) AS max_itemsets FROM ({counts})"""


@query("method_agreement", S.mining_with(*S.itemsets_sql(MIN_SUPPORT, MAX_LEN),
                                         *[cte for m, (support, length) in OWN.items()
                                           for cte in S.itemsets_sql(support, length, name=f"own_{m}")])
       + _AGREE_SQL.format(run="equal", counts=" UNION ALL ".join(
           "SELECT count(*) AS n FROM itemsets" for _ in EQUAL))
       + " UNION ALL " + _AGREE_SQL.format(run="own", counts=" UNION ALL ".join(
           f"SELECT count(*) AS n FROM own_{m}" for m in OWN)))
def method_agreement(spark, sf_dir):
    """Agreement with equal parameters, and with each method's own."""
    with held(mining_baskets(spark, sf_dir)) as tx:
        stats = cut_lineage(B.basket_stats(tx))
        runs = [compare.method_agreement(experiments.method_summary(_mined(tx, settings), stats)).select(
            F.lit(run).alias("run"), "*") for run, settings in (("equal", EQUAL), ("own", OWN))]
        return cut_lineage(runs[0].unionByName(runs[1]))


# -- association rules -------------------------------------------------------

_RULE_CTES = [S.TX, S.ARTICLES, S.BASKETS, S.BASKET_ITEMS, *S.GARMENT_CTES,
              *S.itemsets_sql(RULE_SUPPORT, RULE_MAX_LEN, "garment_items", "garment_baskets"),
              *S.rules_sql("itemsets", MIN_CONFIDENCE)]
_RULES_SQL = S.with_(*_RULE_CTES)
RULE_OUT = ["antecedents", "consequents", "support", "confidence", "lift", "rule_length"]
EXTENDED_OUT = RULE_OUT + ["antecedent_support", "consequent_support", "leverage", "conviction", "zhangs_metric",
                           "jaccard", "certainty", "kulczynski"]


def _rules(spark, sf_dir):
    found = mining.apriori(garment_baskets(spark, sf_dir), RULE_SUPPORT, RULE_MAX_LEN)
    return R.association_rules(found, MIN_CONFIDENCE)


@query("association_rules", _RULES_SQL + f"SELECT {', '.join(RULE_OUT)} FROM rules")
def association_rules(spark, sf_dir):
    return _rules(spark, sf_dir).select(*RULE_OUT)


@query("rules_min_length", _RULES_SQL + f"SELECT {', '.join(RULE_OUT)} FROM rules WHERE rule_length >= 3")
def rules_min_length(spark, sf_dir):
    return R.rules_min_length(_rules(spark, sf_dir), 3).select(*RULE_OUT)


def _top_rules_query(metric: str):
    @query(f"top_rules_by_{metric}", _RULES_SQL + f"""SELECT {', '.join(RULE_OUT)} FROM rules
    ORDER BY {metric} DESC, confidence DESC, support DESC, antecedents, consequents LIMIT {TOP_RESULTS}""")
    def run(spark, sf_dir):
        return R.top_rules(_rules(spark, sf_dir), metric, TOP_RESULTS).select(*RULE_OUT)
    return run


for _metric in R.SORT_METRICS:
    _top_rules_query(_metric)


@query("rule_cards", _RULES_SQL + f"""SELECT {', '.join(RULE_OUT)} FROM rules
ORDER BY lift DESC, confidence DESC, support DESC, antecedents, consequents LIMIT 6""")
def rule_cards(spark, sf_dir):
    """The six rule cards: the lift ordering cut at six."""
    return R.top_rules(_rules(spark, sf_dir), "lift", 6).select(*RULE_OUT)


@query("rule_metrics_extended", _RULES_SQL + f"SELECT {', '.join(EXTENDED_OUT)} FROM rules")
def rule_metrics_extended(spark, sf_dir):
    return _rules(spark, sf_dir).select(*EXTENDED_OUT)


def _side_text(side: str) -> str:
    return f"""(SELECT string_agg(CASE WHEN nm.prod_name IS NOT NULL THEN nm.prod_name || ' (' || u.item || ')'
                          ELSE {S.readable_token('u.item')} END, ' + ' ORDER BY u.pos)
       FROM (SELECT unnest({side}) AS item, unnest(range(1, len({side}) + 1)) AS pos) u
       LEFT JOIN names nm ON nm.article_id = u.item)"""


@query("readable_rules", S.with_(*_RULE_CTES, f"names AS (SELECT {S.zfill('article_id')} AS article_id, prod_name "
                                               "FROM articles)") + f"""
SELECT antecedents, consequents, {_side_text('antecedent_items')} AS antecedent_text,
       {_side_text('consequent_items')} AS consequent_text FROM rules""")
def readable_rules(spark, sf_dir):
    return R.readable_rules(_rules(spark, sf_dir), article_names(spark, sf_dir)).select(
        "antecedents", "consequents", "antecedent_text", "consequent_text")


@query("rule_insights", _RULES_SQL + f"""
SELECT (SELECT count(*) FROM rules) AS rules,
  (SELECT antecedents || ' -> ' || consequents FROM rules ORDER BY confidence DESC, antecedents, consequents LIMIT 1)
    AS best_confidence_rule,
  (SELECT max(confidence) FROM rules) AS best_confidence,
  (SELECT antecedents || ' -> ' || consequents FROM rules ORDER BY lift DESC, antecedents, consequents LIMIT 1)
    AS best_lift_rule,
  (SELECT max(lift) FROM rules) AS best_lift,
  (SELECT max(lift) <= 1.05 FROM rules) AS weak_lift,
  {str(MIN_CONFIDENCE >= 0.7).lower()} AS high_min_confidence""")
def rule_insights(spark, sf_dir):
    return R.rule_insights(_rules(spark, sf_dir), MIN_CONFIDENCE)


@query("pattern_summary", _RULES_SQL + f"""
SELECT (SELECT count(*) FROM garment_baskets) AS transactions,
       (SELECT count(DISTINCT item) FROM garment_items) AS unique_items,
       (SELECT count(*) FROM itemsets WHERE length >= {MIN_ITEMSET_LENGTH}) AS frequent_itemsets,
       (SELECT count(*) FROM itemsets) AS total_frequent_itemsets,
       (SELECT count(*) FROM rules WHERE rule_length >= {MIN_ITEMSET_LENGTH}) AS rules""")
def pattern_summary(spark, sf_dir):
    found = patterns.find_patterns(garment_baskets(spark, sf_dir), RULE_SUPPORT, RULE_MAX_LEN, MIN_CONFIDENCE,
                                   MIN_ITEMSET_LENGTH, TOP_RESULTS)
    return found.summary


# -- experiment grid (H2, H3) ---------------------------------------------------

GRID = [
    dict(name="small", max_baskets=5000, top_items=20, min_support=0.01, max_len=3),
    dict(name="full", max_baskets=0, top_items=0, min_support=0.005, max_len=3),
]


def _grid_sql() -> str:
    ctes = [S.TX, S.ARTICLES, S.BASKETS, S.BASKET_ITEMS, *S.MINING_CTES,
            "pgt AS (SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items FROM pg_baskets)"]
    rows = []
    for c in GRID:
        n = c["name"]
        first = f"SELECT * FROM pgt ORDER BY t_dat, customer_id LIMIT {c['max_baskets']}" if c["max_baskets"] \
            else "SELECT * FROM pgt"
        ctes.append(f"{n}_first AS ({first})")
        ctes.append(f"{n}_parsed AS (SELECT transaction_id, {S.parse_items('items')} AS items FROM {n}_first)")
        if c["top_items"]:
            ctes.append(f"""{n}_top AS (SELECT item FROM (SELECT unnest(items) AS item FROM {n}_parsed) GROUP BY item
                        ORDER BY count(*) DESC, item LIMIT {c['top_items']})""")
            restricted = f"list_intersect(items, (SELECT list(item) FROM {n}_top))"
        else:
            restricted = "items"
        ctes.append(f"""{n}_b AS (SELECT transaction_id, items FROM (
            SELECT transaction_id, list_sort(list_distinct({restricted})) AS items FROM {n}_parsed) WHERE len(items) >= 2)""")
        ctes.append(f"{n}_i AS (SELECT transaction_id, unnest(items) AS item FROM {n}_b)")
        ctes += S.itemsets_sql(c["min_support"], c["max_len"], f"{n}_i", f"{n}_b", f"{n}_sets")
        for m in ("apriori", "fpgrowth", "eclat"):
            rows.append(f"""SELECT '{n}' AS config, '{m}' AS algorithm, (SELECT count(*) FROM {n}_sets) AS frequent_itemsets,
  (SELECT CAST(coalesce(max(length), 0) AS INTEGER) FROM {n}_sets) AS max_itemset_length,
  (SELECT count(*) FROM {n}_b) AS transactions, (SELECT count(DISTINCT item) FROM {n}_i) AS unique_items,
  CAST({c['max_baskets']} AS BIGINT) AS max_baskets, CAST({c['top_items']} AS BIGINT) AS top_items,
  CAST({c['min_support']!r} AS DOUBLE) AS min_support, CAST({c['max_len']} AS INTEGER) AS max_len,
  (SELECT count(*) FROM {n}_sets) AS common_itemsets, CAST(NULL AS VARCHAR) AS start_date,
  CAST(NULL AS VARCHAR) AS end_date, 'ok' AS status, CAST(NULL AS VARCHAR) AS error""")
    return S.with_(*ctes) + "\nUNION ALL\n".join(rows)


@query("experiment_grid", _grid_sql())
def experiment_grid(spark, sf_dir):
    text = cut_lineage(prep.baskets_as_text(product_group_baskets(spark, sf_dir)))
    return experiments.experiment_grid(text, GRID)
