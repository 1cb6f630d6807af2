"""Queries for item sequences, next-item ranking (Q) and evaluation (E)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tillroll.functions.text import parse_article_ids
from tillroll.operators import evaluation as E
from tillroll.operators import sequences as Q
from tillroll.plans.registry import query
from tillroll.session import cut_lineage, held
from tillroll.sources import tables

TOP_K = 10

EV = """ev AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderdate AS order_ts, o_orderkey AS order_key,
                  CAST(l_linenumber AS INTEGER) AS line_no, CAST(l_partkey AS INTEGER) AS old_article_idx
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CAT = """cat AS (SELECT CAST(row_number() OVER (ORDER BY purchases DESC, old_article_idx) AS INTEGER) AS rank,
                    old_article_idx,
                    CAST(row_number() OVER (ORDER BY purchases DESC, old_article_idx) AS INTEGER) AS new_item_idx,
                    purchases
             FROM (SELECT old_article_idx, count(*) AS purchases FROM ev GROUP BY 1
                   ORDER BY purchases DESC, old_article_idx LIMIT 100))"""
ENC = """enc AS (SELECT ev.*, coalesce(c.new_item_idx, 0) AS new_item_idx FROM ev LEFT JOIN cat c USING (old_article_idx))"""
REQ = """req AS (SELECT CAST(order_key AS VARCHAR) || '-' || CAST((line_no - 1) // 8 AS VARCHAR) AS request_id,
                    string_agg(CAST(old_article_idx AS VARCHAR), ',' || chr(10) || ' ' ORDER BY line_no, old_article_idx) AS raw
             FROM ev GROUP BY order_key, (line_no - 1) // 8)"""
TOKENS = """tok AS (SELECT request_id, unnest(t) AS token, unnest(range(0, len(t))) AS pos FROM (
               SELECT request_id, list_filter(regexp_split_to_array(raw, '[,\\s]+'), lambda x: x <> '') AS t FROM req))"""
def _transitions(step: int, tag: str = "") -> str:
    return f"""tr{tag} AS (SELECT a.new_item_idx AS item, b.new_item_idx AS next_item, count(*) AS c
            FROM enc a JOIN enc b ON a.order_key = b.order_key AND b.line_no = a.line_no + {step}
            WHERE a.new_item_idx <> 0 AND b.new_item_idx <> 0 GROUP BY 1, 2),
trs{tag} AS (SELECT item, next_item, CAST(c AS DOUBLE) / CAST(sum(c) OVER (PARTITION BY item) AS DOUBLE) AS score
          FROM tr{tag})"""


TRS = _transitions(1)
ORD_DESC = "order_ts DESC, order_key DESC, line_no DESC, old_article_idx DESC"
LAST = f"""cev AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {ORD_DESC}) AS rn
             FROM enc WHERE new_item_idx <> 0),
lst AS (SELECT customer_id, new_item_idx AS last_item FROM cev WHERE rn = 1),
seen AS (SELECT DISTINCT customer_id, new_item_idx FROM enc WHERE new_item_idx <> 0),
sc AS (SELECT l.customer_id, t.next_item AS new_item_idx, t.score FROM lst l JOIN trs t ON t.item = l.last_item)"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _events(spark, sf_dir):
    return Q.sequence_lines(tables.purchase_lines(spark, sf_dir))


@contextmanager
def _setup(spark, sf_dir):
    """The purchase events, joined once and held while the query runs, and
    the catalogue.  Queries write their result before the events go."""
    with held(_events(spark, sf_dir)) as ev:
        yield ev, cut_lineage(Q.item_catalog(ev))


@query("item_catalog", W(EV, CAT) + "SELECT * FROM cat")
def item_catalog(spark, sf_dir):
    return Q.item_catalog(_events(spark, sf_dir))


REQUEST_LINES = 8


def _requests(ev):
    """Typed requests built from the lines: one per block of at most 8
    consecutive line numbers of an order, so no request text grows with the
    size of an order."""
    block = F.floor((F.col("line_no") - 1) / REQUEST_LINES).cast("bigint")
    rid = F.concat_ws("-", F.col("order_key").cast("string"), block.cast("string")).alias("request_id")
    per_order = ev.groupBy(rid).agg(
        F.sort_array(F.collect_list(F.struct("line_no", "old_article_idx"))).alias("l"))
    return per_order.select("request_id", F.array_join(
        F.transform("l", lambda s: s["old_article_idx"].cast("string")), ",\n ").alias("raw"))


@query("parse_article_ids", W(EV, REQ) + """
SELECT request_id, array_to_string(t, ' ') AS ids, CAST(len(t) AS INTEGER) AS n_ids FROM (
  SELECT request_id, list_filter(regexp_split_to_array(raw, '[,\\s]+'), lambda x: x <> '') AS t FROM req)""")
def parse_article_ids_q(spark, sf_dir):
    r = _requests(_events(spark, sf_dir)).withColumn("t", parse_article_ids("raw"))
    return r.select("request_id", F.array_join("t", " ").alias("ids"), F.size("t").alias("n_ids"))


@query("encode_sequence_zero", W(EV, CAT, ENC) + """
SELECT customer_id, order_key, line_no, old_article_idx, new_item_idx FROM enc""")
def encode_sequence_zero(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        return cut_lineage(Q.encode_zero(ev, cat).select(
            "customer_id", "order_key", "line_no", "old_article_idx", "new_item_idx"))


@query("encode_sequence_drop", W(EV, CAT, REQ, TOKENS) + """
SELECT request_id,
  coalesce(string_agg(CAST(c.new_item_idx AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE c.new_item_idx IS NOT NULL), '')
    AS input_sequence,
  coalesce(string_agg(CAST(c.old_article_idx AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE c.new_item_idx IS NOT NULL), '')
    AS input_article_ids,
  coalesce(string_agg(token, ' ' ORDER BY pos) FILTER (WHERE c.new_item_idx IS NULL), '') AS unknown_article_ids,
  CASE WHEN count(c.new_item_idx) > 0 THEN 'ok' ELSE 'error' END AS status
FROM tok LEFT JOIN cat c ON c.old_article_idx = TRY_CAST(tok.token AS INTEGER)
GROUP BY request_id""")
def encode_sequence_drop(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        out = Q.encode_drop(Q.parse_requests(_requests(ev)), cat)
        return cut_lineage(out.select(
            "request_id", Q.joined_ids("input_sequence").alias("input_sequence"),
            Q.joined_ids("input_article_ids").alias("input_article_ids"),
            F.array_join("unknown_article_ids", " ").alias("unknown_article_ids"), "status"))


@query("pad_sequence", W(EV, CAT, ENC) + f"""
SELECT customer_id, array_to_string(list_resize(l, 20, 0), ' ') AS padded FROM (
  SELECT customer_id, list(new_item_idx ORDER BY order_ts, order_key, line_no, old_article_idx) AS l FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {ORD_DESC}) AS rn FROM enc) WHERE rn <= 20
  GROUP BY customer_id)""")
def pad_sequence_q(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        p = Q.padded_sequences(Q.encode_zero(ev, cat))
        return cut_lineage(p.select("customer_id", Q.joined_ids("padded").alias("padded")))


_TOPK_SQL = f"""
SELECT customer_id, CAST(rank AS INTEGER) AS rank, new_item_idx, old_article_idx, catalog_rank, score FROM (
  SELECT sc.customer_id, sc.new_item_idx, c.old_article_idx, c.rank AS catalog_rank, sc.score,
         row_number() OVER (PARTITION BY sc.customer_id ORDER BY sc.score DESC, sc.new_item_idx) AS rank
  FROM sc JOIN cat c ON c.new_item_idx = sc.new_item_idx
  WHERE sc.new_item_idx <> 0 AND NOT EXISTS (
    SELECT 1 FROM seen s WHERE s.customer_id = sc.customer_id AND s.new_item_idx = sc.new_item_idx))
WHERE rank <= {TOP_K}"""
_POP_SQL = f"""
SELECT customer_id, CAST(rank AS INTEGER) AS rank, new_item_idx, old_article_idx, catalog_rank, score FROM (
  SELECT u.customer_id, p.*, row_number() OVER (PARTITION BY u.customer_id ORDER BY p.score DESC, p.new_item_idx) AS rank
  FROM (SELECT DISTINCT customer_id FROM enc) u CROSS JOIN pop p
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.customer_id = u.customer_id AND s.new_item_idx = p.new_item_idx))
WHERE rank <= {TOP_K}"""
_POP_CTE = """pop AS (SELECT new_item_idx, old_article_idx, rank AS catalog_rank,
               CAST(purchases AS DOUBLE) / CAST((SELECT sum(purchases) FROM cat) AS DOUBLE) AS score FROM cat)"""
_SEEN_CTE = "seen AS (SELECT DISTINCT customer_id, new_item_idx FROM enc WHERE new_item_idx <> 0)"


def _postings(ev, cat):
    return cut_lineage(Q.postings(Q.transition_scores(ev, cat)))


def _by_transition(ev, cat):
    sequences = Q.last_and_seen(Q.catalog_events(Q.encode_zero(ev, cat)))
    return Q.rank_successors(sequences, _postings(ev, cat), cat, Q.clamp_k(TOP_K))


@query("recommend_topk", W(EV, CAT, ENC, TRS, LAST) + _TOPK_SQL)
def recommend_topk(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        return cut_lineage(_by_transition(ev, cat))


@query("recommend_topk_allow_seen", W(EV, CAT, ENC, TRS, LAST) + f"""
SELECT customer_id, CAST(rank AS INTEGER) AS rank, new_item_idx, coalesce(old_article_idx, -1) AS old_article_idx, score
FROM (SELECT sc.customer_id, sc.new_item_idx, c.old_article_idx,
             CASE WHEN sc.new_item_idx = 0 THEN -1.0 ELSE sc.score END AS score,
             row_number() OVER (PARTITION BY sc.customer_id
                                ORDER BY CASE WHEN sc.new_item_idx = 0 THEN -1.0 ELSE sc.score END DESC,
                                         sc.new_item_idx) AS rank
      FROM sc LEFT JOIN cat c ON c.new_item_idx = sc.new_item_idx)
WHERE rank <= {TOP_K}""")
def recommend_topk_allow_seen(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        last = Q.last_event(Q.catalog_events(Q.encode_zero(ev, cat)))
        first = _postings(ev, cat).filter(F.col("rank") <= TOP_K).drop("rank")  # seen or not, no other can be returned
        return cut_lineage(Q.rank_scores_allow_seen(Q.scores_from_last_item(last, first), cat, TOP_K))


@query("popularity_recommend", W(EV, CAT, ENC, _SEEN_CTE, _POP_CTE) + _POP_SQL)
def popularity_recommend(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        return cut_lineage(Q.popularity_recommend(ev, cat, TOP_K))


@query("recommend_all_scorers", W(EV, CAT, ENC, TRS, LAST, _POP_CTE) + f"""
SELECT 'transition' AS scorer, * FROM ({_TOPK_SQL})
UNION ALL
SELECT 'popularity' AS scorer, * FROM ({_POP_SQL})""")
def recommend_all_scorers(spark, sf_dir):
    """Several scorers in one result, ``scorer`` leading the ranking key."""
    with _setup(spark, sf_dir) as (ev, cat):
        by_popularity = Q.popularity_recommend(ev, cat, TOP_K).select(F.lit("popularity").alias("scorer"), "*")
        by_transition = _by_transition(ev, cat).select(F.lit("transition").alias("scorer"), "*")
        return cut_lineage(by_transition.unionByName(by_popularity))


HELD = f"""ccev AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {ORD_DESC}) AS rn
              FROM enc WHERE new_item_idx <> 0),
held AS (SELECT t.customer_id, t.new_item_idx AS target, p.new_item_idx AS prev_item
         FROM ccev t JOIN ccev p ON p.customer_id = t.customer_id AND p.rn = 2 WHERE t.rn = 1),
pr AS (SELECT h.customer_id, c.rank AS target_rank, CAST(NULL AS DOUBLE) AS target_score
       FROM held h LEFT JOIN cat c ON c.new_item_idx = h.target)"""

# scorers of the evaluation: lines so many apart in one order
SCORERS = [("Transition scorer", 1), ("Skip scorer", 2)]


def _ranks(tag: str) -> str:
    return f"""rk{tag} AS (SELECT h.customer_id, r.rk AS target_rank, coalesce(r.score, {E.SCORE_FLOOR}) AS target_score
          FROM held h LEFT JOIN (
          SELECT h2.customer_id, t.next_item, t.score,
                 row_number() OVER (PARTITION BY h2.customer_id ORDER BY t.score DESC, t.next_item) AS rk
          FROM held h2 JOIN trs{tag} t ON t.item = h2.prev_item) r
        ON r.customer_id = h.customer_id AND r.next_item = h.target)"""


def _acc(model: str, src: str) -> str:
    cols = ", ".join(
        f"CAST(sum(CASE WHEN target_rank <= {k} THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS top{k}"
        for k in E.TOP_KS)
    return f"SELECT '{model}' AS model, round(avg(-ln(target_score)), 6) AS loss, {cols} FROM {src}"


ACC = "acc AS (" + " UNION ALL ".join(
    [_acc("Popularity baseline", "pr"), *[_acc(name, f"rk{step}") for name, step in SCORERS]]) + ")"
CMP = "cmp AS (SELECT * FROM acc WHERE NOT contains(lower(model), 'baseline'))"
_E_SQL = W(EV, CAT, ENC, *[_transitions(n, str(n)) for _, n in SCORERS], HELD,
           *[_ranks(str(n)) for _, n in SCORERS], ACC, CMP)


def _accuracy(spark, sf_dir):
    with _setup(spark, sf_dir) as (ev, cat):
        scorers = {name: cut_lineage(Q.transition_scores(ev, cat, step)) for name, step in SCORERS}
        return cut_lineage(E.topk_accuracy(Q.catalog_events(Q.encode_zero(ev, cat)), cat, scorers))


@query("topk_accuracy", _E_SQL + "SELECT * FROM acc")
def topk_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir)


@query("model_comparison", _E_SQL + "SELECT * FROM cmp")
def model_comparison(spark, sf_dir):
    return E.model_comparison(_accuracy(spark, sf_dir))


@query("best_model", _E_SQL + """
SELECT (SELECT model FROM cmp WHERE top20 IS NOT NULL ORDER BY top20 DESC, model LIMIT 1) AS best_top20_model,
       (SELECT max(top20) FROM cmp) AS best_top20,
       (SELECT model FROM cmp WHERE loss IS NOT NULL ORDER BY loss, model LIMIT 1) AS best_loss_model,
       (SELECT min(loss) FROM cmp) AS best_loss""")
def best_model(spark, sf_dir):
    return E.best_model(E.model_comparison(_accuracy(spark, sf_dir)))


@query("metric_heat", _E_SQL + """, lng AS (
  SELECT model, metric, value FROM (UNPIVOT (SELECT model, top1, top3, top5, top10, top20 FROM cmp)
                                   ON top1, top3, top5, top10, top20 INTO NAME metric VALUE value)
  WHERE value IS NOT NULL)
SELECT model, metric, value,
       (value - (SELECT min(value) FROM lng)) / greatest((SELECT max(value) FROM lng) - (SELECT min(value) FROM lng), 1e-9)
         AS intensity
FROM lng""")
def metric_heat(spark, sf_dir):
    return E.metric_heat(E.model_comparison(_accuracy(spark, sf_dir)))
