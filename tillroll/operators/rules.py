"""Association rules from an itemset table, with any consequent size.

Spark ML's ``associationRules`` only emits single-item consequents, so the
rules are enumerated here: every frequent itemset of length ``L >= 2`` is
split by the bit masks ``1 .. 2^L - 2`` (antecedent = set bits), and the
antecedent and consequent supports are looked up with two equi-joins on the
itemset key.  Work is proportional to the output (``2^max_len`` per itemset,
``max_len`` being a user bound) and never touches basket data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import readable_token
from tillroll.session import broadcast_if_small, fits_broadcast

RULE_COLUMNS = ["antecedents", "consequents", "support", "confidence", "lift", "rule_length"]
SORT_METRICS = ("lift", "confidence", "support")


def association_rules(itemsets: DataFrame, min_confidence: float = 0.0, group_cols=()) -> DataFrame:
    """All rules ``A -> C`` (A, C non-empty, disjoint, A u C frequent) with
    ``confidence >= min_confidence``.  Returns arrays ``antecedent_items`` /
    ``consequent_items``, text keys and every metric."""
    if not (0 <= float(min_confidence) <= 1):
        raise ValueError("min_confidence must be in [0, 1]")
    g = list(group_cols)
    lookup = itemsets.select(*g, "itemset_key", "support")
    multi = itemsets.filter(F.col("length") >= 2).select(
        *g, "items", F.col("support").alias("s_ac"),
        F.explode(F.expr("sequence(1L, shiftleft(1L, length) - 2)")).alias("m"))
    split = multi.select(
        *g, "s_ac",
        F.expr("filter(items, (x, i) -> (shiftright(m, i) & 1) = 1)").alias("antecedent_items"),
        F.expr("filter(items, (x, i) -> (shiftright(m, i) & 1) = 0)").alias("consequent_items"),
    ).withColumn("antecedents", F.array_join("antecedent_items", " ")).withColumn(
        "consequents", F.array_join("consequent_items", " "))
    # the itemset table is output-sized; both lookups are the same one
    a = lookup.withColumnsRenamed({"itemset_key": "antecedents", "support": "s_a"})
    c = lookup.withColumnsRenamed({"itemset_key": "consequents", "support": "s_c"})
    if fits_broadcast(lookup):
        a, c = F.broadcast(a), F.broadcast(c)
    r = split.join(a, [*g, "antecedents"]).join(c, [*g, "consequents"])
    r = r.withColumn("confidence", F.col("s_ac") / F.col("s_a"))
    r = r.filter(F.col("confidence") >= F.lit(float(min_confidence)))
    return with_metrics(r).select(
        *g, "antecedent_items", "consequent_items", "antecedents", "consequents",
        F.col("s_ac").alias("support"), "confidence", "lift",
        (F.size("antecedent_items") + F.size("consequent_items")).alias("rule_length"),
        F.col("s_a").alias("antecedent_support"), F.col("s_c").alias("consequent_support"),
        "leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
    )


def with_metrics(r: DataFrame) -> DataFrame:
    """Rule metrics from the supports ``s_ac, s_a, s_c`` (and confidence).

    conviction is +inf at confidence 1; zhang's metric and certainty are 0
    where their denominators are 0 (guards keep ANSI mode from raising)."""
    s_ac, s_a, s_c, conf = F.col("s_ac"), F.col("s_a"), F.col("s_c"), F.col("confidence")
    leverage = s_ac - s_a * s_c
    zhang_den = F.greatest(s_ac * (1 - s_a), s_a * (s_c - s_ac))
    return (r.withColumn("lift", conf / s_c)
            .withColumn("leverage", leverage)
            .withColumn("conviction", F.when(conf < 1, (1 - s_c) / (1 - conf)).otherwise(F.lit(float("inf"))))
            .withColumn("zhangs_metric", F.when(zhang_den == 0, F.lit(0.0)).otherwise(leverage / zhang_den))
            .withColumn("jaccard", s_ac / (s_a + s_c - s_ac))
            .withColumn("certainty", F.when(1 - s_c == 0, F.lit(0.0)).otherwise((conf - s_c) / (1 - s_c)))
            .withColumn("kulczynski", (s_ac / s_a + s_ac / s_c) / 2))


def rules_min_length(rules: DataFrame, min_itemset_length: int) -> DataFrame:
    return rules.filter(F.col("rule_length") >= min_itemset_length)


def top_rules(rules: DataFrame, sort_metric: str = "lift", n: int = 20) -> DataFrame:
    """Order by the chosen metric, then confidence, then support (all
    descending), then the rule text; keep ``n`` (a top-k report)."""
    if sort_metric not in SORT_METRICS:
        raise ValueError(f"sort_metric must be one of {SORT_METRICS}")
    return rules.orderBy(F.desc(sort_metric), F.desc("confidence"), F.desc("support"),
                         F.asc("antecedents"), F.asc("consequents")).limit(n)


def readable_items(rules: DataFrame, names: DataFrame, side: str, out: str) -> DataFrame:
    """One side of each rule as text: ``name (id)`` for known articles,
    otherwise the token without its prefix in title case; joined by `` + ``.

    ``names`` (article id -> name) is catalogue-sized and broadcast behind the
    row check; the per-rule regroup is output-sized."""
    key = [c for c in ("antecedents", "consequents") if c in rules.columns]
    exploded = rules.select(*key, F.posexplode(side).alias("pos", "item"))
    named = exploded.join(broadcast_if_small(names.select(F.col("article_id").alias("item"), "prod_name")),
                          "item", "left")
    text = F.when(F.col("prod_name").isNotNull(), F.concat("prod_name", F.lit(" ("), "item", F.lit(")"))).otherwise(
        readable_token(F.col("item")))
    parts = named.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("pos", text.alias("t")))).alias("p"))
    return rules.join(parts.select(*key, F.array_join(F.transform("p", lambda s: s["t"]), " + ").alias(out)), key)


def readable_rules(rules: DataFrame, names: DataFrame) -> DataFrame:
    out = readable_items(rules, names, "antecedent_items", "antecedent_text")
    return readable_items(out, names, "consequent_items", "consequent_text")


def rule_insights(rules: DataFrame, min_confidence: float) -> DataFrame:
    """Best-confidence and best-lift rule (ties: smaller rule text first) and
    the two advice flags, in one aggregation."""
    best_conf = F.min(F.struct((-F.col("confidence")).alias("k"), "antecedents", "consequents"))
    best_lift = F.min(F.struct((-F.col("lift")).alias("k"), "antecedents", "consequents"))
    agg = rules.agg(best_conf.alias("bc"), best_lift.alias("bl"), F.count(F.lit(1)).alias("rules"))
    return agg.select(
        "rules",
        F.concat_ws(" -> ", "bc.antecedents", "bc.consequents").alias("best_confidence_rule"),
        (-F.col("bc.k")).alias("best_confidence"),
        F.concat_ws(" -> ", "bl.antecedents", "bl.consequents").alias("best_lift_rule"),
        (-F.col("bl.k")).alias("best_lift"),
        ((-F.col("bl.k")) <= 1.05).alias("weak_lift"),
        F.lit(float(min_confidence) >= 0.7).alias("high_min_confidence"),
    )
