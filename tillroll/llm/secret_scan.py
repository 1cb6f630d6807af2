"""Secret scans with a trigram inverted index (DataFrame functions only).

From each rule's regular expression a Boolean query over trigrams is derived:
alternatives of literal text, each of which needs all of its trigrams.  The
index holds, for the trigrams that occur in some query, the ids of the
documents whose lower-cased text has them.  Postings of one alternative are
intersected by counting them per document; documents that satisfy an
alternative are the rule's candidates and are verified with the expression
itself.  A rule with an alternative that needs no trigram scans every text.

Scale: the index rows are bounded by (trigrams in the rules) x documents and
are counted per document after a shuffle of ids alone.  Texts are not shuffled
for the full scan; for the verification only texts that hold the rarest
trigram of an alternative can be candidates, so only those are joined.  Every
span of a text is found in one task, there is no pairing of documents.

Defined cases: null text counts as empty; spans are in code points with the
end exclusive; matches of a kind are leftmost and do not overlap, those under
the rule's minimum length are dropped afterwards; rows that repeat an id are
scanned each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as _c
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, text_or_empty
from tillroll.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    """``least``: characters that group ``group`` of a match must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run is matched whole, so the least length can stand in the expression
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN[A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE
MOST_ALTERNATIVES = 64


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each the trigrams that a lower-cased match must have;
    None where some match needs none."""

    def walk(nodes, states: set) -> set:
        # state: (text that certainly ends here, trigrams so far)
        for op, arg in nodes:
            if op is _c.LITERAL:
                out = set()
                for tail, grams in states:
                    tail = (tail + chr(arg).lower())[-3:]
                    out.add((tail, grams | {tail} if len(tail) == 3 else grams))
                states = out
            elif op is _c.SUBPATTERN:
                states = walk(arg[3], states)
            elif op is _c.BRANCH:
                states = set().union(*(walk(b, states) for b in arg[1]))
            elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT):
                low, high, body = arg
                if (low, high) == (0, 1):
                    states = states | walk(body, states)
                elif low:
                    states = {("", g) for _, g in walk(body, states)} if high != 1 else walk(body, states)
                else:
                    states = {("", g) for _, g in states}
            elif op is not _c.AT:
                states = {("", g) for _, g in states}
            if len(states) > MOST_ALTERNATIVES:
                states = {("", frozenset.intersection(*(g for _, g in states)))}
        return states

    found = {g for _, g in walk(_parser.parse(pattern), {("", frozenset())})}
    if frozenset() in found:
        return None
    return sorted((g for g in found if not any(o < g for o in found)), key=sorted)


def _java(pattern: str) -> str:
    re.compile(pattern)
    return pattern


def _spans(text: Column, rule: Rule, nth: int) -> Column:
    """array<struct<start, kind, stop>> of the rule's matches."""
    p = F.lit(_java(rule.pattern))
    whole = F.regexp_extract_all(text, p, F.lit(0))
    part = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)  # what lies between the matches
    none = F.expr("cast(array() as array<struct<start:int,kind:int,stop:int,ok:boolean>>)")

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        stop = start + F.char_length(m["whole"])
        return F.struct(stop.alias("at"), F.array_append(acc["out"], F.struct(
            start.alias("start"), F.lit(nth).alias("kind"), stop.alias("stop"),
            (F.char_length(m["part"]) >= rule.least).alias("ok"))).alias("out"))

    zipped = F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("w"), part.alias("p")), lambda z: F.struct(
        F.char_length(z["g"]).alias("gap"), z["w"].alias("whole"), z["p"].alias("part")))
    found = F.aggregate(F.filter(zipped, lambda z: z["whole"].isNotNull()),
                        F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.transform(F.filter(found, lambda s: s["ok"]),
                       lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,kind:int,stop:int>>)")


def _rows(docs: DataFrame) -> DataFrame:
    text = text_or_empty(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("h"), F.octet_length("text").alias("len")]


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id): the inverted index, for the trigrams asked for."""
    lowered = _rows(docs).select("doc_id", F.lower("text").alias("t"))
    has = F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(F.col("t"), g))
    return lowered.select("doc_id", F.explode(has).alias("gram"))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, rules): bit r of ``rules`` is set if all trigrams of an
    alternative of rule r are posted for the document."""
    needs = [(g, r, a, len(alt)) for r, alts in queries.items() for a, alt in enumerate(alts) for g in sorted(alt)]
    rows = F.array(*[F.struct(F.lit(g).alias("gram"), F.lit(r).alias("rule"), F.lit(a).alias("alternative"),
                              F.lit(n).alias("need")) for g, r, a, n in needs])
    terms = index.sparkSession.range(1).select(F.explode(rows).alias("t")).select("t.*")  # as many as the rules have
    met = (index.distinct().join(F.broadcast(terms), "gram").groupBy("doc_id", "rule", "alternative")
           .agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need")).filter("n = need"))
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1, rule)")).alias("rules"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found): one row per row; found is the sorted array of
    (start, kind, stop), kind being the rule's place in ``rules``."""
    queries = {r: q for r, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not None}
    full = [r for r in range(len(rules)) if r not in queries]
    rows = _rows(docs)
    direct = _no_spans()
    for r in full:
        gate = F.col("text").rlike(rules[r].pattern)
        direct = F.concat(direct, F.when(gate, _spans(F.col("text"), rules[r], r)).otherwise(_no_spans()))
    scanned = rows.select(*_key(), direct.alias("direct"))
    if not queries:
        return scanned.select("doc_id", F.array_sort("direct").alias("found"))

    grams = sorted({g for alts in queries.values() for alt in alts for g in alt})
    index = cut_lineage(postings(docs, grams))
    by = cut_lineage(candidates(index, queries))
    seen = {r["gram"]: r["count"] for r in index.groupBy("gram").count().collect()}  # one row per trigram of the rules
    rarest = sorted({min(alt, key=lambda g: (seen.get(g, 0), g)) for alts in queries.values() for alt in alts})
    lowered, may = F.lower("text"), F.lit(False)
    for g in rarest:
        may = may | F.contains(lowered, F.lit(g))
    c = broadcast_checked(by.withColumnRenamed("doc_id", "cand_id"))
    verified = _no_spans()
    for r in queries:
        gate = F.col("rules").bitwiseAND(F.lit(1 << r)) != 0
        verified = F.concat(verified, F.when(gate, _spans(F.col("text"), rules[r], r)).otherwise(_no_spans()))
    some = rows.filter(may)
    some = some.join(c, some["doc_id"].eqNullSafe(c["cand_id"])).select(*_key(), verified.alias("verified"))
    some = cut_lineage(some.filter(F.size("verified") > 0).dropDuplicates(["doc_id", "h", "len"])
                       .withColumnsRenamed({"doc_id": "v_id", "h": "v_h", "len": "v_len"}))
    s = broadcast_checked(some)
    joined = scanned.join(s, scanned["doc_id"].eqNullSafe(s["v_id"]) & (scanned["h"] == s["v_h"])
                          & (scanned["len"] == s["v_len"]), "left")
    return joined.select("doc_id", F.array_sort(
        F.concat("direct", F.coalesce("verified", _no_spans()))).alias("found"))


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """"kind:start:stop", comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count_of(kind: int):
    return lambda n, k: n + (k == kind).cast("long")


def digest(found: DataFrame, base: int = len(BASE), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the first ``base`` rules, digest of their spans, all spans."""
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [F.aggregate(kinds, F.lit(0).cast("long"), _count_of(r)).alias(f"n_{rules[r].kind}") for r in range(base)]
    own = F.filter("found", lambda s: s["kind"] < base)
    return found.select("doc_id", *counts, F.sha2(span_text(own, rules), 256).alias("base_sha256"),
                        span_text(F.col("found"), rules).alias("spans"))
