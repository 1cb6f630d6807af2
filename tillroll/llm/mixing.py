"""Mixing sources to target weights by pivotal dependent rounding.

A source's target fixes the expected number of copies of each of its
documents; the whole part is taken outright, the rest is a copy probability.
Pivotal rounding pairs two documents with fractional probabilities and moves
probability from one to the other, at random in the direction that keeps both
expectations, until one of the two is 0 or 1.  The move is weighed by size, so
the pair's expected words stay the same to the last word.  The one document of
a source that is open at the end goes to the nearer side, so a source ends
within half a document of its target.

The pairing is a reduction tree.  Documents of a source are hashed into groups
of about ``GROUP`` rows; a group is folded pair by pair and leaves one
fractional document; these are grouped again, up to one per source.  Large
documents are paired first, so the open one at the end is a small one.  A source
that holds a third of all rows has more groups, not larger ones, and every
level shrinks the rows by ``GROUP``.  Everything is DataFrame functions.  The
random numbers are hashes of the two documents and the level, so reruns agree.

Defined cases: null text has size 0; sizes of 0 take nothing; a null source is
a source, the last one; rows that repeat id, source and size are numbered and
each is rounded alone; sources with no words have target 0; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import broadcast_checked, text_or_empty
from tillroll.session import cut_lineage

WEIGHTS = (5, 2, 1)   # by rank of the source, repeating
MOST = 3              # copies of a document, and times a source's size
GROUP = 128
RUN = 1000            # numbers of repeated rows made from one row
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _units(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, m): rows that repeat all three counted in m."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(text_or_empty(docs)).alias("size"))
            .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")))


def _rows(units: DataFrame) -> DataFrame:
    """``units`` with ``row`` = 1..m instead of m: one row per row.  A unit of
    very many rows is cut into runs that different tasks number."""
    cols = [c for c in units.columns if c != "m"]
    runs = units.filter(F.col("m") > RUN).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(RUN).cast("long"))).alias("from"))
    runs = runs.repartition("doc_id", "source", "size", "from")
    each = units.filter(F.col("m") <= RUN).withColumn("from", F.lit(0).cast("long")).unionByName(runs)
    last = F.least(F.col("m"), F.col("from") + RUN)
    return each.select(*cols, F.explode(F.sequence(F.col("from") + 1, last)).alias("row"))


def source_targets(units: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n, weight, target), a written table with one row
    per source.  Targets are ``level * weight`` or ``most`` times the source's
    size if that is less; the level is raised until all words are shared."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                       F.sum("m").alias("n"))
    order = F.asc_nulls_last("source")
    numbered = cut_lineage(sums.repartitionByRange(order).sortWithinPartitions(order)
                           .withColumn("id", F.monotonically_increasing_id())
                           .select("*", F.shiftright("id", 33).alias("part"),
                                   F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")))
    parts = numbered.groupBy("part").count()  # one row per partition
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("before"))
    pick = F.array(*[F.lit(x).cast("long") for x in weights])
    ranked = cut_lineage(numbered.join(parts, "part").select(
        "source", "source_size", "n",
        F.get(pick, ((F.col("before") + F.col("nth")) % len(weights)).cast("int")).alias("weight")))

    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, last = 0.0, -1
    while True:
        full = F.lit(float(most)) * F.col("source_size") <= F.lit(level) * F.col("weight")
        n_full, in_full, open_weight = ranked.agg(
            F.count_if(full), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n_full == last or not open_weight:
            break
        last, level = n_full, (total - most * (in_full or 0)) / open_weight
    return cut_lineage(ranked.withColumn(
        "target", F.least(F.lit(level) * F.col("weight"), F.lit(float(most)) * F.col("source_size"))))


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _uniform(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0 ** -53)


def _doc(x: Column, p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
    return F.struct(x["size"].alias("size"), x["order"].alias("order"), x["doc_id"].alias("doc_id"),
                    x["row"].alias("row"), p.alias("p"))


def _settled(x: Column, up: int) -> Column:
    return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["row"].alias("row"), F.lit(up).alias("up"))


def _step(level: int, seed: int):
    """Fold step: pair the open document ``a`` with the next one ``b``; one
    of them settles, the other stays open."""

    def step(acc: Column, b: Column) -> Column:
        a = acc["open"]
        words_a, words_b = a["size"].cast("double"), b["size"].cast("double")
        sizes = F.struct((words_b / words_a).alias("ba"), (words_a / words_b).alias("ab"),
                         _uniform(F.lit(seed), F.lit(level), a["order"], b["order"], a["doc_id"], b["doc_id"], a["row"], b["row"]
                                  ).alias("u"))

        def moves(s: Column) -> Column:
            up = F.least(1 - a["p"], b["p"] * s["ba"])      # a gains, b loses
            down = F.least(a["p"], (1 - b["p"]) * s["ba"])  # a loses, b gains
            gains = s["u"] * (up + down) < down

            def both(keep: Column, out: Column) -> Column:
                return F.struct(keep.alias("open"), F.array_append(acc["out"], out).alias("out"))

            return (F.when(gains & (1 - a["p"] <= b["p"] * s["ba"]),
                           both(_doc(b, b["p"] - (1 - a["p"]) * s["ab"]), _settled(a, 1)))
                    .when(gains, both(_doc(a, a["p"] + b["p"] * s["ba"]), _settled(b, 0)))
                    .when(a["p"] <= (1 - b["p"]) * s["ba"],
                          both(_doc(b, b["p"] + a["p"] * s["ab"]), _settled(a, 0)))
                    .otherwise(both(_doc(a, a["p"] - (1 - b["p"]) * s["ba"]), _settled(b, 1))))

        return _let(sizes, moves)

    return step


def _round_level(items: DataFrame, level: int, seed: int) -> DataFrame:
    """(source, groups, open, out): every group folded."""
    none = "cast(array() as array<struct<doc_id:bigint,size:bigint,row:bigint,up:int>>)"
    grouped = items.groupBy("source", "groups", "nth").agg(
        F.sort_array(F.collect_list(F.struct("size", "order", "doc_id", "row", "p")), asc=False).alias("items"))
    first = F.struct(F.col("items")[0].alias("open"), F.expr(none).alias("out"))
    rest = F.slice("items", 2, F.size("items"))
    return grouped.select("source", "groups", F.aggregate(rest, first, _step(level, seed)).alias("r")).select(
        "source", "groups", "r.open", "r.out")


def pivotal_round(items: DataFrame, group: int = GROUP, seed: int = 1) -> DataFrame:
    """``items`` (source, n, doc_id, size > 0, row, p in (0, 1)) with up = 0 or
    1 instead of p; ``n`` is the number of documents of the source."""
    settled, level = [], 0
    cur = items.withColumn("groups", F.ceil(F.col("n") / group).cast("long"))
    fields = ("doc_id", "size", "row")
    while not cur.isEmpty():  # sources of different sizes end at different levels
        order = F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "size", "row")
        ready = cur.select("source", "groups", order.alias("order"), *fields, "p")
        ready = ready.withColumn("nth", F.pmod("order", "groups"))
        done = cut_lineage(_round_level(ready, level, seed))
        settled.append(done.select("source", F.explode("out").alias("o")).select("source", "o.*"))
        last = F.col("groups") == 1
        final = F.col("open.p") >= 0.5  # nothing is left to pair it with: the nearer side
        settled.append(done.filter(last).select("source", *[f"open.{c}" for c in fields],
                                                final.cast("int").alias("up")))
        cur = done.filter(~last).select("source", F.ceil(F.col("groups") / group).cast("long").alias("groups"), "open.*")
        level += 1
    if not settled:
        return items.select("source", *fields, F.lit(0).alias("up"))
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, group: int = GROUP, seed: int = 1) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, row: one row
    per row; ``row`` numbers the rows of equal id, source and size."""
    units = cut_lineage(_units(docs))
    targets = broadcast_checked(source_targets(units, weights, most))
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))
                   ).otherwise(F.lit(0.0))
    u, t = _rows(units).alias("u"), targets.alias("t")
    rated = u.join(t, F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "u.source", "size", "row", "n", ratio.alias("ratio")).withColumn(
        "p", F.col("ratio") - F.floor("ratio"))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    up = pivotal_round(rated.filter(open_), group, seed)
    rows = up.unionByName(rated.filter(~open_).select("source", "doc_id", "size", "row", F.lit(0).alias("up")))
    copies = F.floor(ratio) + F.col("up")
    r = rows.alias("r")
    return r.join(t, F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "r.source", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), "row")


KEY = ["__mix_id", "__mix_source", "__mix_size"]


def _same_key(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for c in names:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def _numbered(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``__mix_row`` = 1, 2, ... within equal ``KEY``.  The rows
    are written, numbered within what one task wrote, and moved up by the rows
    of the tasks before; no task gathers all rows of a key."""
    staged = cut_lineage(keyed.withColumn("__mix_nth", F.monotonically_increasing_id()))
    part = F.shiftright("__mix_nth", 33).alias("__mix_part")
    inside = Window.partitionBy(*KEY, "__mix_part").orderBy("__mix_nth")
    rows = staged.select("*", part).withColumn("__mix_at", F.row_number().over(inside))
    sizes = staged.select(*KEY, part).groupBy(*KEY, "__mix_part").agg(F.count(F.lit(1)).alias("__mix_n"))
    before = Window.partitionBy(*KEY).orderBy("__mix_part").rowsBetween(Window.unboundedPreceding, -1)
    names = [*KEY, "__mix_part"]
    offsets = sizes.select(*names, F.coalesce(F.sum("__mix_n").over(before), F.lit(0)).alias("__mix_before"))
    moved = rows.join(offsets, _same_key(rows, offsets, names))
    return moved.select(*[rows[f"`{c}`"] for c in keyed.columns],
                        (F.col("__mix_at") + F.col("__mix_before")).alias("__mix_row"))


def take_copies(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` (all its columns), each row as often as the mix takes it."""
    cols = docs.columns
    plan = cut_lineage(mix(docs, **parameters).select(
        F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("size").alias("__mix_size"),
        F.col("row").alias("__mix_row"), F.col("copies").cast("int").alias("__mix_copies")))
    keyed = docs.select("*", docs["doc_id"].cast("long").alias(KEY[0]), docs["source"].cast("string").alias(KEY[1]),
                        word_count(text_or_empty(docs)).alias(KEY[2]))
    repeated = cut_lineage(plan.filter(F.col("__mix_row") == 2).select(*KEY))
    one = F.lit(1).cast("long").alias("__mix_row")
    if repeated.isEmpty():
        rows = keyed.select("*", one)
    else:
        r = broadcast_checked(repeated)
        rows = keyed.join(r, _same_key(keyed, r, KEY), "left_anti").select("*", one).unionByName(
            _numbered(keyed.join(r, _same_key(keyed, r, KEY), "left_semi")))
    plan = broadcast_checked(plan)
    joined = rows.join(plan, _same_key(rows, plan, [*KEY, "__mix_row"]))
    return joined.select(*[rows[f"`{c}`"] for c in cols],
                         F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies"))).alias("__mix_copy")).select(
        *[f"`{c}`" for c in cols])
