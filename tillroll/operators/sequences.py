"""Item sequences and next-item ranking over score tables.

The reference scores one typed sequence at a time with a neural model whose
weights it does not ship.  Here every customer is scored at once and the
scorer is a table ``(seq_id, new_item_idx, score)``; two scorers derived from
the purchase lines are provided: popularity (the published baseline) and
within-order transitions (a stand-in for the missing model).

Id space: ``new_item_idx`` 1..N is the catalogue rank, 0 is padding/unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.arrays import MAX_SEQ_LEN, PADDING_ID, pad_sequence
from tillroll.functions.text import parse_article_ids
from tillroll.session import broadcast_if_small

# Fixed values of the recommender setup.
CATALOG_SIZE = 100
TOP_K_MIN, TOP_K_MAX = 1, 20
ORDER_KEY = ["order_ts", "order_key", "line_no", "old_article_idx"]


def clamp_k(k: int) -> int:
    return min(max(int(k), TOP_K_MIN), TOP_K_MAX)


def sequence_lines(lines: DataFrame) -> DataFrame:
    """Purchase events ``(customer_id, order_ts, order_key, line_no, old_article_idx)``;
    an article id that is no integer becomes null, which every encoding
    treats as unknown."""
    return lines.select(
        "customer_id", "order_ts", "order_key", F.col("sales_channel_id").alias("line_no"),
        F.expr("try_cast(article_id AS INT)").alias("old_article_idx"))


def item_catalog(events: DataFrame, size: int = CATALOG_SIZE) -> DataFrame:
    """Top ``size`` items by purchases (ties: lower id); rank = new id."""
    counts = events.filter(F.col("old_article_idx").isNotNull()).groupBy("old_article_idx").agg(
        F.count(F.lit(1)).alias("purchases"))
    top = counts.orderBy(F.desc("purchases"), F.asc("old_article_idx")).limit(size)
    # ``top`` has ``size`` rows: numbering it is a top-k step
    w = Window.orderBy(F.desc("purchases"), F.asc("old_article_idx"))
    ranked = top.withColumn("rank", F.row_number().over(w))
    return ranked.select("rank", "old_article_idx", F.col("rank").alias("new_item_idx"), "purchases")


def _catalog_b(catalog: DataFrame) -> DataFrame:
    return broadcast_if_small(catalog.select("old_article_idx", "new_item_idx", "rank"))


def encode_zero(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Map each event to its catalogue id; unknown -> 0."""
    return events.join(_catalog_b(catalog).drop("rank"), "old_article_idx", "left").withColumn(
        "new_item_idx", F.coalesce("new_item_idx", F.lit(PADDING_ID)))


def parse_requests(raw: DataFrame, text_col: str = "raw") -> DataFrame:
    """Typed id lists -> one row per token with its position; a list without
    any token keeps one row with a null token."""
    return raw.select("*", F.posexplode_outer(parse_article_ids(text_col)).alias("pos", "token"))


def encode_drop(tokens: DataFrame, catalog: DataFrame, key: str = "request_id") -> DataFrame:
    """Known ids in input order, and the unknown or non-integer tokens.

    ``try_cast`` keeps non-integers as null (dropped, reported); the join
    is with the catalogue.  A request with nothing known, or without any
    token, gets ``status = 'error'``.  Requests are short typed lists, so
    gathering one request's tokens is bounded by its text."""
    t = tokens.withColumn("old_article_idx", F.expr("try_cast(token AS INT)"))
    joined = t.join(_catalog_b(catalog).drop("rank"), "old_article_idx", "left")
    known = F.when(F.col("new_item_idx").isNotNull(), F.struct("pos", "new_item_idx", "old_article_idx"))
    unknown = F.when(F.col("token").isNotNull() & F.col("new_item_idx").isNull(), F.struct("pos", "token"))
    out = joined.groupBy(key).agg(
        F.sort_array(F.collect_list(known)).alias("k"), F.sort_array(F.collect_list(unknown)).alias("u"))
    return out.select(
        key,
        F.transform("k", lambda s: s["new_item_idx"]).alias("input_sequence"),
        F.transform("k", lambda s: s["old_article_idx"]).alias("input_article_ids"),
        F.transform("u", lambda s: s["token"]).alias("unknown_article_ids"),
        F.when(F.size("k") > 0, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
    )


def last_n(encoded: DataFrame, n: int = MAX_SEQ_LEN, key: str = "customer_id") -> DataFrame:
    """The last ``n`` events per sequence, in order, as an array.

    The filter on the row number lets Spark keep ``n`` rows per sequence and
    task before the shuffle, so a customer with a third of all events brings
    at most ``n`` rows from each task."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in ORDER_KEY])
    kept = encoded.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    gathered = kept.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in ORDER_KEY], "new_item_idx"))).alias("s"))
    return gathered.select(key, F.transform("s", lambda s: s["new_item_idx"]).alias("sequence"))


def padded_sequences(encoded: DataFrame, n: int = MAX_SEQ_LEN, key: str = "customer_id") -> DataFrame:
    seqs = last_n(encoded, n, key)
    return seqs.select(key, pad_sequence("sequence", n).alias("padded"))


def catalog_events(encoded: DataFrame) -> DataFrame:
    """Events of catalogue items only (the sequences the models work on)."""
    return encoded.filter(F.col("new_item_idx") != PADDING_ID)


def last_event(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """Last item per sequence by the event order: ``max`` of a struct is a
    partial aggregate, safe for a hot key."""
    last = F.max(F.struct(*[F.col(c) for c in ORDER_KEY], "new_item_idx"))
    return events.groupBy(key).agg(last.alias("_l")).select(
        key, F.col("_l.new_item_idx").alias("last_item"),
        *[F.col(f"_l.{c}").alias(f"last_{c}") for c in ORDER_KEY])


def transition_scores(events: DataFrame, catalog: DataFrame, step: int = 1) -> DataFrame:
    """``P(j follows i)`` from lines of one order that are ``step`` apart.

    The lines meet by an equi-join on ``(order, line + step)``, not by a
    window over the order, so a huge order is split by the join (AQE skew
    handling) instead of being sorted in one task."""
    enc = encode_zero(events, catalog).filter(F.col("new_item_idx") != PADDING_ID)
    a = enc.select("order_key", "line_no", F.col("new_item_idx").alias("item"))
    b = enc.select("order_key", (F.col("line_no") - step).alias("line_no"), F.col("new_item_idx").alias("next_item"))
    pairs = a.join(b, ["order_key", "line_no"]).groupBy("item", "next_item").agg(F.count(F.lit(1)).alias("c"))
    totals = pairs.groupBy("item").agg(F.sum("c").alias("t"))
    # at most (catalogue size)^2 rows
    return pairs.join(totals, "item").select(
        "item", "next_item", (F.col("c").cast("double") / F.col("t").cast("double")).alias("score"))


def postings(transitions: DataFrame) -> DataFrame:
    """``transitions`` with the ``rank`` of every successor within its item:
    score desc, lower id first.  Ranked once, whoever asks; an item has at
    most (catalogue size) successors."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("next_item"))
    return transitions.withColumn("rank", F.row_number().over(order))


def scores_from_last_item(last: DataFrame, transitions: DataFrame, key: str = "customer_id") -> DataFrame:
    """Score table per sequence: successors of its last item (<= catalogue size each)."""
    t = broadcast_if_small(transitions)
    return last.join(t, last.last_item == t.item).select(key, F.col("next_item").alias("new_item_idx"), "score")


def last_and_seen(events: DataFrame, key: str = "customer_id") -> DataFrame:
    """Per sequence the last item and the set of items, from events of
    catalogue items: two partial aggregates in one shuffle."""
    last = F.max(F.struct(*[F.col(c) for c in ORDER_KEY], "new_item_idx"))
    return events.groupBy(key).agg(last.alias("_l"), F.collect_set("new_item_idx").alias("seen")).select(
        key, F.col("_l.new_item_idx").alias("last_item"), "seen")


def rank_successors(sequences: DataFrame, ranked: DataFrame, catalog: DataFrame, k: int,
                    key: str = "customer_id") -> DataFrame:
    """Top ``k`` unseen successors of each sequence's last item.

    ``sequences`` as ``last_and_seen`` gives them, ``ranked`` as ``postings``.
    Of ``k`` plus the seen items' number of successors at least ``k`` are
    unseen, or all there are, so each sequence asks for exactly those ranks:
    an equi-join on (item, rank) of at most ``k + seen`` rows a sequence, and
    a window over those."""
    want = sequences.filter(F.lit(k > 0)).select(
        key, "seen", F.col("last_item").alias("item"), F.explode(F.sequence(F.lit(1), F.lit(int(k)) + F.size("seen"))).alias("rank"))
    met = want.join(broadcast_if_small(ranked), ["item", "rank"]).filter(~F.array_contains("seen", F.col("next_item")))
    met = met.select(key, F.col("next_item").alias("new_item_idx"), "score", F.col("rank").alias("posting"))
    met = met.join(_catalog_b(catalog).withColumnRenamed("rank", "catalog_rank"), "new_item_idx")
    order = Window.partitionBy(key).orderBy("posting")
    top = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select(key, F.col("rank").cast("int").alias("rank"), "new_item_idx", "old_article_idx", "catalog_rank", "score")


def rank_scores(scores: DataFrame, catalog: DataFrame, k: int, seen: DataFrame | None = None,
                key: str = "customer_id", by: list[str] | None = None) -> DataFrame:
    """Top ``k`` per sequence: score desc, then lower id;
    id 0 and ids outside the catalogue never returned; ``seen`` (key, id)
    blocked through an anti-join.  ``by`` adds partition columns, e.g. a
    ``scorer`` column when one score table holds several models.  Each
    (scorer, sequence) has at most one score per catalogue id, so the window
    is bounded by the catalogue."""
    part = [*(by or []), key]
    s = scores.filter(F.col("new_item_idx") != PADDING_ID)
    if seen is not None:
        s = s.join(seen.select(key, "new_item_idx"), [key, "new_item_idx"], "left_anti")
    s = s.join(_catalog_b(catalog).withColumnRenamed("rank", "catalog_rank"), "new_item_idx")
    w = Window.partitionBy(*part).orderBy(F.desc("score"), F.asc("new_item_idx"))
    ranked = s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(*part, F.col("rank").cast("int").alias("rank"), "new_item_idx", "old_article_idx",
                         "catalog_rank", "score")


def answer_request(scores: DataFrame, catalog: DataFrame, k: int, **how) -> DataFrame:
    """``rank_scores`` as a request reaches it: ``k`` clamped to 1..20."""
    return rank_scores(scores, catalog, clamp_k(k), **how)


def rank_scores_allow_seen(scores: DataFrame, catalog: DataFrame, k: int, key: str = "customer_id") -> DataFrame:
    """The simple form: id 0 forced last (score -1), seen items allowed, an
    id without a catalogue entry decodes to old id -1."""
    s = scores.withColumn("score", F.when(F.col("new_item_idx") == PADDING_ID, F.lit(-1.0)).otherwise(F.col("score")))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("new_item_idx"))
    ranked = s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    dec = ranked.join(_catalog_b(catalog).drop("rank"), "new_item_idx", "left")
    return dec.select(key, F.col("rank").cast("int").alias("rank"), "new_item_idx",
                      F.coalesce("old_article_idx", F.lit(-1)).alias("old_article_idx"), "score")


def popularity_recommend(events: DataFrame, catalog: DataFrame, k: int, key: str = "customer_id") -> DataFrame:
    """Popularity baseline: score = share of purchases; seen items blocked.

    Scores are equal for every sequence, so a sequence that has seen ``s``
    catalogue items only needs the global ranks ``1 .. k + s``: each sequence
    emits exactly those ranks (an equi-join on rank with the catalogue), and
    no sequence x catalogue product is formed.  Ranks end with the catalogue,
    whatever its size."""
    cat = catalog.select("rank", "old_article_idx", "new_item_idx", "purchases")
    size, total = cat.agg(F.count(F.lit(1)), F.sum("purchases")).first()
    scored = cat.withColumn("score", F.col("purchases").cast("double") / F.lit(float(total or 1)))
    enc = encode_zero(events, catalog)
    # one row per sequence with its seen items: at most the catalogue each
    seen = enc.groupBy(key).agg(F.collect_set(F.when(F.col("new_item_idx") != PADDING_ID, F.col("new_item_idx"))).alias("seen"))
    last = F.least(F.lit(int(k)) + F.size("seen"), F.lit(int(size)))
    want = seen.filter(F.lit(size > 0 and k > 0)).select(key, "seen", F.explode(F.sequence(F.lit(1), last)).alias("rank"))
    cand = want.join(broadcast_if_small(scored), "rank").filter(~F.array_contains("seen", F.col("new_item_idx")))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("new_item_idx"))
    ranked = cand.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    return ranked.select(key, F.col("r").cast("int").alias("rank"), "new_item_idx", "old_article_idx",
                         F.col("rank").alias("catalog_rank"), "score")


def seen_items(encoded: DataFrame, key: str = "customer_id") -> DataFrame:
    return catalog_events(encoded).select(key, "new_item_idx").distinct()


def joined_ids(c: Column | str) -> Column:
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string")), " ")
