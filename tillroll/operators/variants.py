"""Basket variants: category roll-ups, customer age segments, year ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import safe_token, title_case, zfill
from tillroll.session import broadcast_if_small

# Segment keys and closed bounds (age cut to int first).
AGE_GROUPS = [
    ("age_under_25", 0, 24),
    ("age_25_34", 25, 34),
    ("age_35_44", 35, 44),
    ("age_45_plus", 45, 200),
]

# Category variants (variant key = token prefix, article column).
CATEGORY_VARIANTS = [
    ("product_group", "product_group_name"),
    ("garment_group", "garment_group_name"),
    ("section", "section_name"),
]
OUTFIT_VARIANT = ("outfit", "garment_group_name")

BASKET_COLUMNS = ["transaction_id", "customer_id", "t_dat", "items", "item_count"]


def article_category_map(articles: DataFrame, column: str, prefix: str) -> DataFrame:
    """``article_id`` (padded) -> ``prefix_token``; a null label -> ``unknown``.

    Duplicated ids keep the largest token (a total order, so the choice does
    not depend on file order)."""
    mapped = articles.select(
        zfill("article_id").alias("article_id"),
        F.concat(F.lit(prefix + "_"), safe_token(F.coalesce(F.col(column), F.lit("unknown")))).alias("category"),
    )
    return mapped.groupBy("article_id").agg(F.max("category").alias("category"))


def category_baskets(baskets: DataFrame, mapping: DataFrame, min_items: int = 2,
                     map_rows: int | None = None) -> DataFrame:
    """Roll baskets up to a category: map each item (ids are not re-padded),
    drop unmapped, distinct, sort, keep ``>= min_items``.

    The map has one row per article (catalogue-sized), broadcast behind a
    row-count check.  Regrouping uses the basket key columns, so when the
    input is still hash-partitioned on ``(customer_id, t_dat)`` (straight
    from ``build_baskets``) Spark adds no exchange."""
    m = broadcast_if_small(mapping.select(F.col("article_id").alias("item"), "category"), known_rows=map_rows)
    exploded = baskets.select("customer_id", "t_dat", "transaction_id", F.explode("items").alias("item"))
    grouped = exploded.join(m, "item").groupBy("customer_id", "t_dat", "transaction_id").agg(
        F.array_sort(F.collect_set("category")).alias("items")
    )
    return grouped.select(
        "transaction_id", "customer_id", "t_dat", "items", F.size("items").cast("bigint").alias("item_count")
    ).filter(F.col("item_count") >= min_items)


def category_variants(baskets: DataFrame, articles: DataFrame, specs: list[tuple[str, str, str]],
                      min_items: int = 2, map_rows: int | None = None) -> DataFrame:
    """Several category roll-ups in one pass: ``specs`` = (variant, column,
    prefix).  Items are exploded once and joined once with a map of one row
    per article, which has a token for each column there is; a basket's rows
    are gathered once, with a set for each column, and become a row per
    variant after that.  So what is shuffled is one row per item, not one per
    item and variant, and prefixes are added behind the shuffle.  The
    basket-key partitioning of the input already satisfies the regrouping."""
    columns = list(dict.fromkeys(col for _, col, _ in specs))
    token = {col: f"_token{i}" for i, col in enumerate(columns)}
    # duplicated ids keep the largest token per variant, as in article_category_map
    m = articles.select(zfill("article_id").alias("item"), *[
        safe_token(F.coalesce(F.col(c), F.lit("unknown"))).alias(token[c]) for c in columns])
    m = broadcast_if_small(m.groupBy("item").agg(*[F.max(t).alias(t) for t in token.values()]), known_rows=map_rows)
    keys = ["customer_id", "t_dat", "transaction_id"]
    exploded = baskets.select(*keys, F.explode("items").alias("item"))
    grouped = exploded.join(m, "item").groupBy(*keys).agg(*[
        F.sort_array(F.collect_set(t)).alias(t) for t in token.values()])

    def of(variant: str, column: str, prefix: str) -> Column:
        named = F.transform(token[column], lambda x: F.concat(F.lit(prefix + "_"), x))
        return F.struct(F.lit(variant).alias("variant"), named.alias("items"))

    each = grouped.select(*keys, F.inline(F.filter(F.array(*[of(*spec) for spec in specs]),
                                                   lambda v: F.size(v["items"]) >= min_items)))
    return each.select(
        "variant", "transaction_id", "customer_id", "t_dat", "items", F.size("items").cast("bigint").alias("item_count"))


def customer_age_groups(customers: DataFrame, groups=AGE_GROUPS) -> DataFrame:
    """One age group per customer; null ages dropped; age truncated to int;
    bounds closed.  A customer id listed several times takes the *last*
    matching group in list order (``max`` of the group index: partial
    aggregation, so a repeated id is never gathered in one task)."""
    age = F.col("age").cast("int")
    idx = None
    for i, (_, lo, hi) in enumerate(groups):
        cond = (age >= lo) & (age <= hi)
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    keyed = customers.filter(F.col("age").isNotNull()).select(
        F.col("customer_id").cast("string").alias("customer_id"), idx.alias("g")
    ).filter(F.col("g").isNotNull())
    best = keyed.groupBy("customer_id").agg(F.max("g").alias("g"))
    names = F.array(*[F.lit(k) for k, _, _ in groups])
    return best.select("customer_id", F.element_at(names, F.col("g") + 1).alias("age_group"))


def age_baskets(baskets: DataFrame, age_groups: DataFrame, min_items: int = 2,
                group_rows: int | None = None) -> DataFrame:
    """One basket set per age group (``variant`` column); unknown customers dropped.

    The customer side grows with the customer base, so it is broadcast only
    behind the row-count check; otherwise a shuffle join (AQE splits skew)."""
    b = baskets.filter(F.col("item_count") >= min_items)
    g = broadcast_if_small(age_groups, known_rows=group_rows)
    return b.join(g, "customer_id").select(F.col("age_group").alias("variant"), *BASKET_COLUMNS)


YEAR_PREFIX = "year_"  # of the variants that stand for calendar years


def calendar_year() -> Column:
    """The variant of a basket's own year; a day that begins with no year has none."""
    year = F.substring("t_dat", 1, 4)
    return F.when(year.rlike("^[0-9]{4}$"), F.concat(F.lit(YEAR_PREFIX), year))


def range_table(spark: SparkSession, ranges) -> DataFrame:
    """``(variant, start, end)``: closed ranges of text days, given as a table
    or a list."""
    if isinstance(ranges, DataFrame):
        return ranges.select("variant", "start", "end")
    return spark.createDataFrame(list(ranges), "variant string, start string, end string")


def in_ranges(baskets: DataFrame, ranges) -> DataFrame:
    """``baskets`` with the ``variant`` of every range that holds their day: a
    row for each.  An interval join on months: a range stands in every month
    it touches, baskets meet it on the month of their day, and the bounds are
    compared for those pairs alone."""
    table = range_table(baskets.sparkSession, ranges)
    first, last = (F.expr(f"try_to_date(`{c}`, 'yyyy-MM-dd')") for c in ("start", "end"))
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    bins = table.filter(first <= last).select("variant", "start", "end", F.explode(months).alias("m"))
    bins = bins.select("variant", "start", "end", F.date_format("m", "yyyy-MM").alias("_month"))
    met = baskets.withColumn("_month", F.substring("t_dat", 1, 7)).join(broadcast_if_small(bins), "_month")
    return met.filter(F.col("t_dat").between(F.col("start"), F.col("end"))).drop("_month", "start", "end")


def year_baskets(baskets: DataFrame, ranges=None, min_items: int = 2) -> DataFrame:
    """One basket set per closed day range.  Without ``ranges`` the calendar
    years of the baskets themselves; else a table (variant, start, end) or a
    list of such rows (a basket in two overlapping ranges gets two rows)."""
    b = baskets.filter(F.col("item_count") >= min_items)
    if ranges is None:
        return b.withColumn("variant", calendar_year()).filter(F.col("variant").isNotNull()).select(
            "variant", *BASKET_COLUMNS)
    return in_ranges(b, ranges).select("variant", *BASKET_COLUMNS)


def segment_variants(baskets: DataFrame, age_groups: DataFrame, ranges=None, min_items: int = 2,
                     group_rows: int | None = None) -> DataFrame:
    """Year and age-group variants in one pass: each basket gets the array of
    its labels (its year, then its customer's age group, via a left join) and
    is exploded once per label.  The left join adds no inferred filter below
    the basket aggregation, so this branch and the category branch share one
    basket-building shuffle (exchange reuse).  Given ``ranges`` take the place
    of the years."""
    b = baskets.filter(F.col("item_count") >= min_items)
    j = b.join(broadcast_if_small(age_groups, known_rows=group_rows), "customer_id", "left")
    labels = [F.col("age_group")] if ranges is not None else [calendar_year(), F.col("age_group")]
    out = j.select(F.explode(F.array_compact(F.array(*labels))).alias("variant"), *BASKET_COLUMNS)
    return out if ranges is None else out.unionByName(year_baskets(baskets, ranges, min_items))


def with_variant(df: DataFrame, variant: str) -> DataFrame:
    return df.select(F.lit(variant).alias("variant"), *BASKET_COLUMNS)


def year_ranges(baskets: DataFrame) -> list[tuple[str, str, str]]:
    """One closed range per calendar year that has a basket."""
    years = sorted(r[0] for r in baskets.select(F.substring("t_dat", 1, 4).alias("y")).distinct().collect() if r[0])
    return [(f"year_{y}", f"{y}-01-01", f"{y}-12-31") for y in years]


def all_variants(baskets: DataFrame, articles: DataFrame, customers: DataFrame, min_items: int = 2,
                 ranges=None) -> DataFrame:
    """Every variant in one long table with a ``variant`` column; ``ranges``
    are day ranges in place of the calendar years there are.

    Broadcast checks use the dimension row counts (answered from Parquet
    footers): a map derived from a dimension has at most as many rows."""
    n_articles, n_customers = articles.count(), customers.count()
    specs = [(key, column, key) for key, column in CATEGORY_VARIANTS]
    specs.append(("outfit_category", OUTFIT_VARIANT[1], OUTFIT_VARIANT[0]))
    parts = [segment_variants(baskets, customer_age_groups(customers), ranges, min_items, n_customers),
             category_variants(baskets, articles, specs, min_items, n_articles)]
    return reduce(DataFrame.unionByName, parts)


def variant_labels() -> list[tuple[str, str, str]]:
    """``(key, label, description)`` of the variants that are no day ranges, in list order."""
    out = [("base", "Base", "All baskets of articles")]
    for key, column in CATEGORY_VARIANTS:
        out.append((key, key.replace("_", " ").title(), f"Baskets of {column} values"))
    out.append(("outfit_category", "Outfit Category", f"Baskets of {OUTFIT_VARIANT[1]} values as outfits"))
    out += [(k, k.replace("_", " ").title(), f"Baskets of customers aged {lo} to {hi}") for k, lo, hi in AGE_GROUPS]
    return out


def variant_manifest(variants: DataFrame, folder: str = "variants", ranges=None) -> DataFrame:
    """Key, label, path, description and rows of every variant that has
    rows, and the base entry, whose rows are not counted (null).  Day ranges
    are the calendar years among the variants, or the given ``ranges``."""
    spark = variants.sparkSession
    rows = variants.groupBy(F.col("variant").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    names = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(label).alias("label"), F.lit(text).alias("description"))
                      for k, label, text in variant_labels()])
    if ranges is None:
        year = F.substring("key", len(YEAR_PREFIX) + 1, 4)
        days = rows.filter(F.col("key").rlike(f"^{YEAR_PREFIX}[0-9]{{4}}$")).select(
            F.col("key").alias("variant"), F.concat(year, F.lit("-01-01")).alias("start"),
            F.concat(year, F.lit("-12-31")).alias("end"))
    else:
        days = range_table(spark, ranges)
    told = days.select(F.col("variant").alias("key"), title_case(F.translate("variant", "_", " ")).alias("label"),
                       F.concat(F.lit("Baskets from "), "start", F.lit(" to "), "end").alias("description"))
    entries = spark.range(1).select(F.inline(names)).unionByName(told)  # one row per variant there can be
    path = F.concat(F.lit(folder.rstrip("/") + "/variant="), F.col("key"))
    return entries.join(rows, "key", "left").filter(F.col("rows").isNotNull() | (F.col("key") == "base")).select(
        "key", "label", F.when(F.col("key") == "base", F.lit(folder.rstrip("/"))).otherwise(path).alias("path"),
        "description", "rows")
