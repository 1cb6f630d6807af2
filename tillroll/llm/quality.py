"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model on a few features of the whole text gives each document's own
evidence.  Sites differ, so the evidence is combined with what is known of the
document's host and path: the sum of the documents' probabilities (labels where
there are any) per path and per host, shrunk towards the level above.  A host's
rate is shrunk to the global rate, a path's to its host's, each by a
concentration estimated from all groups by the method of moments, so a site
with few documents says little and a large one speaks for itself.  A document
does not count towards its own prior.

Scale: features are made where the text is read and are a few numbers a row.
Group sums are partial aggregates; a host with a third of all rows is one row
per map task.  The model is fitted on at most ``sample_rows`` labelled rows in
hash order; rates, concentrations and scores cover all documents.

Defined cases: null text is empty; null host or path is a group of its own;
without labels of both kinds every document's own evidence is neutral; null
labels do not count; of several labels of a document the smallest counts;
repeated rows are scored each; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, map_arrow, text_or_empty
from tillroll.session import cut_lineage

SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
FEATURES = ("log_words", "word_length", "distinct", "signs", "upper", "digits", "bars", "log_lines", "repeats",
            "signed_words")
_CLIP = 1e-4


def text_features(text: bytes) -> tuple:
    """Features of a whole text, in the order of ``FEATURES``."""
    import math
    import re

    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    signs = len(text) - len(text.translate(None, b"#$%&*@!^~<>{}[]\\_+="))
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    signed = len(re.findall(rb"[#$%&*@!^~]{2}(?=\s|$)", text))
    return (math.log1p(len(words)), size / n, len(set(words)) / n, signs / size, upper / size, digits / size,
            (text.count(b"|") + text.count(b"\t")) / n, math.log1p(text.count(b"\n")), repeats / n, signed / n)


def features(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, x): one row per row."""

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            x = [list(text_features(t.as_py())) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "host", "path", "x"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"),
                      path.cast("string").alias("path"), text_or_empty(docs).alias("text"))
    return map_arrow(src, measure, "doc_id long, host string, path string, x array<double>")


def fit_logistic(x, y, ridge: float = 1.0, rounds: int = 30):
    """(intercept, weights, base rate) on the raw features."""
    import numpy as np

    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.concatenate([np.ones((len(x), 1)), np.clip((x - mean) / scale, -8, 8)], axis=1)
    w, penalty = np.zeros(z.shape[1]), np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-6 * np.eye(len(w)),
                               z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:], mean, scale, float(y.mean())


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_CLIP)), F.lit(1 - _CLIP))
    return F.log(p / (1 - p))


def _expit(v: Column) -> Column:
    return 1 / (1 + F.exp(-v))


def concentration(rows: DataFrame, total: Column, n: Column, towards: Column) -> float:
    """Method of moments: how many documents the level above is worth.  The
    groups' squared distance from ``towards`` is what chance alone would give
    (one part in n) plus what the groups really differ by."""
    m = towards * (1 - towards)
    got = rows.agg(F.sum(n * F.pow(total / n - towards, 2)), F.sum(m), F.sum(n * m)).first()
    spread, chance, mass = (float(v or 0.0) for v in got)
    if mass <= 0:
        return 1.0
    share = max(0.0, (spread - chance) / max(mass - chance, 1e-12))  # of the variance that is between groups
    return min(1e6, max(1.0, 1 / share - 1)) if share > 0 else 1e6


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample_rows: int = SAMPLE_ROWS,
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, host, path, doc_score, host_rate, path_rate, score, keep)."""
    import numpy as np

    rows = cut_lineage(features(docs, host, path))
    known = labels.filter(labels["quality"].isNotNull() & labels["doc_id"].isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").cast("double").alias("y"))
    rows = cut_lineage(rows.join(known, rows["doc_id"] == known["label_id"], "left").drop("label_id"))
    some, total = rows.filter("y is not null"), rows.filter("y is not null").count()
    if total > sample_rows:  # by the hash first, so that about so many rows are sorted in all
        share = min(1.0, 1.1 * sample_rows / total + 0.001)
        some = some.filter(F.xxhash64("doc_id") <= F.lit(min(int(share * 2 ** 64) - 2 ** 63, 2 ** 63 - 1)))
    sample = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select("x", "y").collect()
    y = np.array([r["y"] for r in sample])
    if len(set(y)) == 2:
        intercept, w, mean, scale, base = fit_logistic(np.array([r["x"] for r in sample]), y)
        pull = F.lit(intercept)
        for i, (a, m, s) in enumerate(zip(w, mean, scale)):
            v = (F.col("x")[i] - float(m)) / float(s)
            pull = pull + float(a) * F.least(F.greatest(v, F.lit(-8.0)), F.lit(8.0))
        evidence = pull - float(np.log(base / (1 - base)))
    else:
        base = float(y.mean()) if len(y) else 0.5
        evidence = F.lit(0.0)
    base_logit = float(np.log(max(base, _CLIP) / max(1 - base, _CLIP)))
    rated = rows.select("doc_id", "host", "path", evidence.alias("evidence"),
                        _expit(evidence + base_logit).alias("doc_score"), "y")
    rated = cut_lineage(rated.withColumn("share", F.coalesce("y", "doc_score")))

    paths = cut_lineage(rated.groupBy("host", "path").agg(F.sum("share").alias("path_sum"),
                                                          F.count(F.lit(1)).alias("path_n")))
    hosts = cut_lineage(paths.groupBy("host").agg(F.sum("path_sum").alias("host_sum"),
                                                  F.sum("path_n").alias("host_n")))
    total = hosts.agg(F.sum("host_sum"), F.sum("host_n")).first()
    rate = float(total[0] / total[1]) if total[1] else 0.5
    k_host = concentration(hosts, F.col("host_sum"), F.col("host_n"), F.lit(rate))
    host_mean = (F.col("host_sum") + k_host * rate) / (F.col("host_n") + k_host)
    sites = cut_lineage(paths.join(broadcast_checked(hosts.withColumnRenamed("host", "of")),
                                   F.col("host").eqNullSafe(F.col("of"))).drop("of"))
    k_path = concentration(sites, F.col("path_sum"), F.col("path_n"), host_mean)

    s = broadcast_checked(sites.withColumnsRenamed({"host": "s_host", "path": "s_path"}))
    joined = rated.join(s, rated["host"].eqNullSafe(s["s_host"]) & rated["path"].eqNullSafe(s["s_path"]))
    own = F.col("share")
    host_rate = (F.col("host_sum") - own + k_host * rate) / (F.col("host_n") - 1 + k_host)
    path_rate = (F.col("path_sum") - own + k_path * F.col("host_rate")) / (F.col("path_n") - 1 + k_path)
    out = joined.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
    out = out.withColumn("score", _expit(F.col("evidence") + _logit(F.col("path_rate"))))
    return out.select("doc_id", "host", "path", "doc_score", "host_rate", "path_rate", "score",
                      (F.col("score") >= threshold).alias("keep"))
