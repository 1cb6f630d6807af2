"""Evaluation and metric tables: top-K accuracy, model comparison, heat map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import sequences as Q
from tillroll.session import broadcast_if_small, cut_lineage

# K of the published accuracy columns, and the heat-map span floor.
TOP_KS = [1, 3, 5, 10, 20]
SPAN_FLOOR = 1e-9
SCORE_FLOOR = 1e-6  # of a target that the scorer does not list, for the loss
METRIC_COLUMNS = ["loss", "top1", "top3", "top5", "top10", "top20"]


def holdout(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """Per sequence of catalogue items with at least two events: the held-out
    last item and the item before it (two partial aggregates, no window)."""
    last = Q.last_event(events, key)
    order = [F.col(c) for c in Q.ORDER_KEY]
    before = events.join(last.select(key, *[F.col(f"last_{c}") for c in Q.ORDER_KEY]), key)
    earlier = F.struct(*order) < F.struct(*[F.col(f"last_{c}") for c in Q.ORDER_KEY])
    prev = before.filter(earlier).groupBy(key).agg(
        F.max(F.struct(*order, "new_item_idx")).alias("_p")).select(key, F.col("_p.new_item_idx").alias("prev_item"))
    return last.select(key, F.col("last_item").alias("target")).join(prev, key)


def popularity_ranks(held: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rank of the target under the popularity scorer (seen allowed); the
    published baseline has no loss, so there is no score."""
    ranks = broadcast_if_small(catalog.select(F.col("new_item_idx").alias("target"), F.col("rank").alias("target_rank")))
    return held.join(ranks, "target", "left").withColumn("target_score", F.lit(None).cast("double"))


def transition_ranks(held: DataFrame, transitions: DataFrame) -> DataFrame:
    """Rank of the target among the successors of the previous item (score
    desc, lower id first); a target without a transition is a miss.  The rank
    is the posting's own, so one equi-join on (item, next item) finds it."""
    ranked = broadcast_if_small(Q.postings(transitions).select(
        F.col("item").alias("prev_item"), F.col("next_item").alias("target"), F.col("rank").alias("target_rank"),
        F.col("score").alias("target_score")))
    return held.join(ranked, ["prev_item", "target"], "left").withColumn(
        "target_score", F.coalesce("target_score", F.lit(SCORE_FLOOR)))


def accuracy_row(model: str, ranked: DataFrame) -> DataFrame:
    """``avg(rank <= K)`` for every K and the mean cross-entropy of the
    target's score (to 6 decimals) in one aggregation."""
    n = F.count(F.lit(1)).cast("double")
    aggs = [(F.sum(F.when(F.col("target_rank") <= k, 1).otherwise(0)).cast("double") / n).alias(f"top{k}")
            for k in TOP_KS]
    loss = F.round(F.avg(-F.log("target_score")), 6).alias("loss")
    return ranked.agg(loss, *aggs).select(F.lit(model).alias("model"), "loss", *[f"top{k}" for k in TOP_KS])


def topk_accuracy(events: DataFrame, catalog: DataFrame, scorers: dict[str, DataFrame],
                  key: str = "customer_id") -> DataFrame:
    """One row for the popularity baseline and one per transition table."""
    held = cut_lineage(holdout(events, key))
    rows = [accuracy_row("Popularity baseline", popularity_ranks(held, catalog))]
    rows += [accuracy_row(name, transition_ranks(held, t)) for name, t in scorers.items()]
    return reduce(DataFrame.unionByName, rows)


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Drop rows whose model name contains ``baseline`` (any case); NaN -> null."""
    kept = metrics.filter(~F.lower(F.col("model")).contains("baseline"))
    return kept.select("model", *[F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c)
                                  for c in METRIC_COLUMNS])


def best_model(comparison: DataFrame) -> DataFrame:
    """Best Top-20 (highest) and best loss (lowest), nulls ignored; ties by name."""
    return comparison.agg(
        F.min(F.when(F.col("top20").isNotNull(), F.struct((-F.col("top20")).alias("k"), "model"))).alias("b20"),
        F.min(F.when(F.col("loss").isNotNull(), F.struct(F.col("loss").alias("k"), "model"))).alias("bl"),
    ).select(F.col("b20.model").alias("best_top20_model"), (-F.col("b20.k")).alias("best_top20"),
             F.col("bl.model").alias("best_loss_model"), F.col("bl.k").alias("best_loss"))


def metric_heat(comparison: DataFrame) -> DataFrame:
    """Long ``(model, metric, value)`` over the accuracy columns with a
    min-max scaled ``intensity``; the min and max are one global aggregate
    (a single row, used as a scalar)."""
    acc = [f"top{k}" for k in TOP_KS]
    long = comparison.select("model", *acc).unpivot(["model"], acc, "metric", "value").filter(
        F.col("value").isNotNull())
    ends = long.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    span = F.greatest(ends["hi"] - ends["lo"], F.lit(SPAN_FLOOR))
    return long.withColumn("intensity", (F.col("value") - ends["lo"]) / span)
