"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (ann, decontaminate, exact_dedup, fim, langid, line_dedup, mixing, packing, quality,
                          secret_scan, simhash, token_orc, whitening)
from tillroll.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(key: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn

    return wrap


@query("op1_exact_dedup", """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query("op3_token_orc")
def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_orc.write_token_orc(table(spark, sf_dir, "documents"), path, vocabulary())
    return token_orc.digests(spark, path)


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op5_mix_sources")
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' source stands for the host, its languages for paths."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, table(spark, sf_dir, "labels"), docs["source"],
                         F.concat_ws("/", docs["source"], docs["lang"]))


@query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ann.build_index(ann.valid_vectors(table(spark, sf_dir, "embeddings")))
    if index is None:
        return ann.search(None, spark.range(0))
    return ann.search(index, index.rows.filter(F.col("vec_id") % 20 == 0))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_line_dedup", r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i
  FROM documents),
z AS (SELECT doc_id, i AS a, line, lead(i) OVER w AS b, lead(line) OVER w AS next
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
p AS (SELECT doc_id, a, b, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, a) > 1 AS again
      FROM z WHERE b IS NOT NULL),
c AS (SELECT doc_id, a, b, CASE WHEN a = lag(b) OVER (PARTITION BY doc_id ORDER BY a) THEN 0 ELSE 1 END AS starts
      FROM p WHERE again),
g AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM c),
t AS (SELECT doc_id, sum(starts) AS chunks FROM c GROUP BY doc_id),
x AS (SELECT l.doc_id, count(*) AS n, count(g.i) AS lost,
             string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT x.doc_id, n::INT AS n_lines, coalesce(chunks, 0)::INT AS removed_chunks, lost::INT AS removed_lines,
       coalesce(x.text, '') AS text
FROM x LEFT JOIN t USING (doc_id)
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_benchmark_decontamination", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
r AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
g AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS run
  FROM d, (SELECT DISTINCT k FROM r), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
h AS (SELECT doc_id, k, i, item FROM g JOIN r USING (k, run)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query("op13_fill_in_middle", r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS s,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents),
h AS (
  SELECT *, len(w) AS n, ('0x' || s[1:8])::BIGINT % (len(w) + 1) AS a, ('0x' || s[9:16])::BIGINT % (len(w) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || s[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || s[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (
  SELECT *, coalesce(array_to_string(w[1:least(a, b)], ''), '') AS prefix,
         coalesce(array_to_string(w[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
         coalesce(array_to_string(w[greatest(a, b) + 1:], ''), '') AS suffix
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::DOUBLE AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::DOUBLE AS middle_chars,  -- as pandas reads a long with nulls
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
