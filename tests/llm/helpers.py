import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASHING = ("h", "len", "fp", "copies", "pos", "name", "level", "size", "taken", "score", "kept", "row", "bucket", "key")
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lamda mu nu xi".split()


def frame(spark, rows, extra=()):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for c in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(c, F.lit("other"))
    return df


def odd_rows(seed=1, long=20_000):
    """Nulls, empty and very long texts, ties, repeated rows, odd letters."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, "ÀB É ß İ K ſ Ω"), (5, "àb É ß İ k ſ Ω"), (None, "no id"),
            (None, None), (7, "same Text"), (8, "SAME text"), (9, "same text"), (9, "same text"), (9, "same text two"),
            (10, " ".join(rng.choices(WORDS, k=long))), (11, "x" * (long * 4 + 3)), (12, "1234 5678 !!"), (13, "語 日本")]
    rows += [(20 + i, " ".join(rng.choices(WORDS, k=rng.randint(1, 60)))) for i in range(30)]
    base = " ".join(rng.choices(WORDS, k=400))
    rows += [(100 + i, base.replace("alpha", "alpha" if i else "beta", 1) + (" tail" if i % 3 == 0 else "")) for i in range(6)]
    return rows


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
