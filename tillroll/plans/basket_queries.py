"""Queries for profiling (D), basket loading (B) and variants (V, S10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.text import parse_items, safe_token
from tillroll.operators import baskets as B
from tillroll.operators import profile, variants
from tillroll.plans.inputs import MIN_ITEMS, basket_arrays, basket_text, mining_text_baskets
from tillroll.plans.registry import query
from tillroll.plans import sql as S
from tillroll.session import cut_lineage, held
from tillroll.sources import tables

DATE_FROM, DATE_TO = "1996-01-01", "1998-12-31"
FIRST_N = 5000
TOP_N = 100
LOAD_ARGS = dict(max_baskets=5000, start_date="1995-06-01", end_date="2000-12-31", top_items_n=500, min_items=2)

PROFILE_TABLES = {
    "transactions": ["t_dat", "customer_id", "article_id", "price", "sales_channel_id"],
    "articles": ["article_id", "prod_name", "product_type_name", "product_group_name", "department_name",
                 "section_name", "garment_group_name"],
    "customers": ["customer_id", "age", "club_member_status"],
}
PROFILE_SOURCES = {"transactions": "tx", "articles": "articles", "customers": "customers"}


def _profile_tables(spark, sf_dir):
    return {
        "transactions": tables.transactions_wide(spark, sf_dir),
        "articles": tables.articles_raw(spark, sf_dir),
        "customers": tables.customers(spark, sf_dir),
    }


def _profile_sql(expr: str, value: str) -> str:
    parts = []
    for name, cols in PROFILE_TABLES.items():
        for c in cols:
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"CAST({expr.format(c=c)} AS BIGINT) AS {value} FROM {PROFILE_SOURCES[name]}")
    return S.with_(S.TX, S.ARTICLES, S.CUSTOMERS) + "\nUNION ALL\n".join(parts)


@query("profile_shape", S.with_(S.TX, S.ARTICLES, S.CUSTOMERS) + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST({len(c)} AS BIGINT) AS n_columns FROM {PROFILE_SOURCES[n]}"
    for n, c in PROFILE_TABLES.items()))
def profile_shape(spark, sf_dir):
    return profile.profile_shape(_profile_tables(spark, sf_dir))


@query("profile_nulls", _profile_sql("count(*) - count({c})", "null_count"))
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(_profile_tables(spark, sf_dir))


@query("profile_distinct", _profile_sql("count(DISTINCT {c})", "distinct_count"))
def profile_distinct(spark, sf_dir):
    found = _profile_tables(spark, sf_dir)
    with held(found["transactions"]) as lines:  # a join, which each column's aggregate would compute
        return cut_lineage(profile.profile_distinct({**found, "transactions": lines}))


@query("profile_date_range", S.with_(S.TX) + "SELECT min(t_dat) AS min_date, max(t_dat) AS max_date FROM tx")
def profile_date_range(spark, sf_dir):
    return profile.profile_date_range(tables.transactions(spark, sf_dir))


@query("top_articles", S.with_(S.TX) + """
SELECT article_id, count(*) AS line_count FROM tx GROUP BY article_id ORDER BY line_count DESC, article_id LIMIT 10""")
def top_articles(spark, sf_dir):
    return profile.top_articles(tables.transactions(spark, sf_dir), 10)


# -- basket loading ---------------------------------------------------------

_LIST_TEXT = "'[' || array_to_string(list_transform(items, lambda x: '''' || x || ''''), ', ') || ']'"


@query("parse_items", S.with_(S.TX, S.BASKETS) + f"""
SELECT transaction_id,
       array_to_string({S.parse_items("array_to_string(items, ' ')")}, ' ') AS from_text,
       array_to_string({S.parse_items(_LIST_TEXT)}, ' ') AS from_list
FROM baskets""")
def parse_items_q(spark, sf_dir):
    b = basket_arrays(spark, sf_dir)
    as_list = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                       F.lit("]"))
    return b.select(
        "transaction_id",
        F.array_join(parse_items(F.array_join("items", " ")), " ").alias("from_text"),
        F.array_join(parse_items(as_list), " ").alias("from_list"),
    )


@query("baskets_date_filter", S.with_(S.TX, S.BASKETS, S.BASKETS_TEXT) + f"""
SELECT * FROM baskets_text WHERE t_dat >= '{DATE_FROM}' AND t_dat <= '{DATE_TO}'""")
def baskets_date_filter(spark, sf_dir):
    return B.date_filter(basket_text(spark, sf_dir), DATE_FROM, DATE_TO)


@query("baskets_first_n", S.with_(S.TX, S.BASKETS, S.BASKETS_TEXT) + f"""
SELECT * FROM baskets_text ORDER BY t_dat, customer_id LIMIT {FIRST_N}""")
def baskets_first_n(spark, sf_dir):
    return B.first_n(basket_text(spark, sf_dir), FIRST_N)


_PARSED = f"""parsed AS (SELECT transaction_id, t_dat, customer_id,
  {S.parse_items("items")} AS items FROM baskets_text)"""
_FREQ = """freq AS (SELECT item, count(*) AS frequency FROM (SELECT unnest(items) AS item FROM parsed) GROUP BY item)"""
_TOP = f"""top AS (SELECT item, frequency FROM freq ORDER BY frequency DESC, item LIMIT {TOP_N})"""
_RESTRICTED = """restricted AS (
  SELECT transaction_id, list_sort(list_distinct(list_intersect(items, (SELECT list(item) FROM top)))) AS items
  FROM parsed)"""
_B_CTES = [S.TX, S.BASKETS, S.BASKETS_TEXT, _PARSED, _FREQ, _TOP, _RESTRICTED]


def _parsed(spark, sf_dir):
    return B.with_parsed_items(basket_text(spark, sf_dir))


@query("item_frequency", S.with_(*_B_CTES) + "SELECT item, frequency FROM freq")
def item_frequency(spark, sf_dir):
    return B.item_frequency(_parsed(spark, sf_dir))


@query("top_items", S.with_(*_B_CTES) + "SELECT item, frequency FROM top")
def top_items(spark, sf_dir):
    return B.top_items(_parsed(spark, sf_dir), TOP_N)


@query("baskets_restrict_items", S.with_(*_B_CTES) + """
SELECT transaction_id, array_to_string(items, ' ') AS items FROM restricted""")
def baskets_restrict_items(spark, sf_dir):
    p = cut_lineage(_parsed(spark, sf_dir))  # read twice: for the counts and for the restriction
    r = B.restrict_items(p, B.top_items(p, TOP_N))
    return r.select("transaction_id", F.array_join("items", " ").alias("items"))


@query("baskets_min_items", S.with_(*_B_CTES) + f"""
SELECT transaction_id, array_to_string(items, ' ') AS items FROM restricted WHERE len(items) >= {MIN_ITEMS}""")
def baskets_min_items(spark, sf_dir):
    p = cut_lineage(_parsed(spark, sf_dir))  # read twice: for the counts and for the restriction
    r = B.min_items_filter(B.restrict_items(p, B.top_items(p, TOP_N)), MIN_ITEMS)
    return r.select("transaction_id", F.array_join("items", " ").alias("items"))


_LB = LOAD_ARGS
_LOAD_CTES = [S.TX, S.BASKETS, S.BASKETS_TEXT, f"""lb_first AS (
  SELECT * FROM baskets_text WHERE t_dat >= '{_LB['start_date']}' AND t_dat <= '{_LB['end_date']}'
  ORDER BY t_dat, customer_id LIMIT {_LB['max_baskets']})""",
              f"lb_parsed AS (SELECT transaction_id, t_dat, {S.parse_items('items')} AS items FROM lb_first)",
              f"""lb_top AS (SELECT item FROM (SELECT unnest(items) AS item FROM lb_parsed) GROUP BY item
                  ORDER BY count(*) DESC, item LIMIT {_LB['top_items_n']})""",
              """lb_out AS (SELECT transaction_id, t_dat, items FROM (
                  SELECT transaction_id, t_dat,
                         list_sort(list_distinct(list_intersect(items, (SELECT list(item) FROM lb_top)))) AS items
                  FROM lb_parsed) WHERE len(items) >= 2)"""]


@query("load_baskets", S.with_(*_LOAD_CTES) + """
SELECT transaction_id, t_dat, array_to_string(items, ' ') AS items FROM lb_out""")
def load_baskets(spark, sf_dir):
    out = B.load_baskets(basket_text(spark, sf_dir), **LOAD_ARGS)
    return out.withColumn("items", F.array_join("items", " "))


@query("basket_stats", S.mining_with() + """
SELECT (SELECT count(*) FROM mining_baskets) AS transactions,
       (SELECT count(DISTINCT item) FROM mining_items) AS unique_items""")
def basket_stats(spark, sf_dir):
    return B.basket_stats(mining_text_baskets(spark, sf_dir))


@query("basket_incidence", S.mining_with() + "SELECT transaction_id, item FROM mining_items")
def basket_incidence(spark, sf_dir):
    return B.basket_incidence(mining_text_baskets(spark, sf_dir))


@query("incidence_vectors", S.with_(S.TX, S.BASKETS, """vocab AS (
  SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM (SELECT DISTINCT unnest(items) AS item FROM baskets))""",
                                    "cells AS (SELECT transaction_id, unnest(items) AS item FROM baskets)") + """
SELECT transaction_id, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size,
       string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY idx) AS indices, string_agg('1', ' ') AS "values"
FROM cells JOIN vocab USING (item) GROUP BY transaction_id""")
def incidence_vectors(spark, sf_dir):
    """All article baskets over all articles they hold, as sparse vectors."""
    v = B.incidence_vectors(basket_arrays(spark, sf_dir).select("transaction_id", "items"))
    whole = F.transform("values", lambda x: x.cast("int").cast("string"))
    return v.select("transaction_id", "size", F.array_join(F.transform("indices", lambda i: i.cast("string")), " ").alias("indices"),
                    F.array_join(whole, " ").alias("values"))


# -- variants ---------------------------------------------------------------

_TOKEN_COLUMNS = ["product_group_name", "garment_group_name", "section_name", "prod_name"]


@query("safe_token", S.with_(S.ARTICLES) + "\nUNION\n".join(
    f"SELECT '{c}' AS column_name, {c} AS value, {S.safe_token(c)} AS token FROM articles" for c in _TOKEN_COLUMNS))
def safe_token_q(spark, sf_dir):
    arts = tables.articles_raw(spark, sf_dir)
    parts = [arts.select(F.lit(c).alias("column_name"), F.col(c).alias("value"), safe_token(c).alias("token"))
             for c in _TOKEN_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


@query("article_category_map", S.with_(S.ARTICLES, S.category_map("product_group_name", "product_group", "m"))
       + "SELECT article_id, category FROM m")
def article_category_map(spark, sf_dir):
    return variants.article_category_map(tables.articles_raw(spark, sf_dir), "product_group_name", "product_group")


def _category_query(key: str, column: str, prefix: str):
    oracle = S.with_(S.TX, S.ARTICLES, S.BASKETS, S.BASKET_ITEMS, S.category_map(column, prefix, "m"),
                     S.category_baskets("m", "cb")) + """
SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items, item_count FROM cb"""

    @query(key, oracle)
    def run(spark, sf_dir):
        arts = tables.articles_raw(spark, sf_dir)
        m = variants.article_category_map(arts, column, prefix)
        return B_text(variants.category_baskets(basket_arrays(spark, sf_dir), m, MIN_ITEMS, map_rows=arts.count()))

    return run


def B_text(df):
    return df.withColumn("items", F.array_join("items", " "))


for _key, _column in variants.CATEGORY_VARIANTS:
    _category_query(f"category_baskets_{_key}", _column, _key)
_category_query("outfit_baskets", variants.OUTFIT_VARIANT[1], variants.OUTFIT_VARIANT[0])


@query("customer_age_groups", S.with_(S.CUSTOMERS, S.AGE_GROUPS) + "SELECT customer_id, age_group FROM age_groups")
def customer_age_groups(spark, sf_dir):
    return variants.customer_age_groups(tables.customers(spark, sf_dir))


_AGE_B = """age_b AS (SELECT g.age_group AS variant, b.transaction_id, b.customer_id, b.t_dat,
                   array_to_string(b.items, ' ') AS items, b.item_count
  FROM baskets b JOIN age_groups g ON g.customer_id = b.customer_id WHERE b.item_count >= 2)"""
_YEAR_B = """year_b AS (SELECT r.variant, b.transaction_id, b.customer_id, b.t_dat,
                   array_to_string(b.items, ' ') AS items, b.item_count
  FROM baskets b JOIN year_ranges r ON b.t_dat >= r.start_day AND b.t_dat <= r.end_day WHERE b.item_count >= 2)"""


@query("age_baskets", S.with_(S.TX, S.CUSTOMERS, S.BASKETS, S.AGE_GROUPS, _AGE_B) + "SELECT * FROM age_b")
def age_baskets(spark, sf_dir):
    cust = tables.customers(spark, sf_dir)
    g = variants.customer_age_groups(cust)
    return B_text(variants.age_baskets(basket_arrays(spark, sf_dir), g, MIN_ITEMS, group_rows=cust.count()))


@query("year_baskets", S.with_(S.TX, S.BASKETS, S.YEAR_RANGES, _YEAR_B) + "SELECT * FROM year_b")
def year_baskets(spark, sf_dir):
    return B_text(variants.year_baskets(basket_arrays(spark, sf_dir), min_items=MIN_ITEMS))


_MANIFEST_CTES = [S.TX, S.ARTICLES, S.CUSTOMERS, S.BASKETS, S.BASKET_ITEMS, S.AGE_GROUPS, S.YEAR_RANGES, _AGE_B,
                  _YEAR_B]
_manifest_parts = ["SELECT variant FROM year_b", "SELECT variant FROM age_b"]
for _key, _column in variants.CATEGORY_VARIANTS + [("outfit", variants.OUTFIT_VARIANT[1])]:
    _MANIFEST_CTES += [S.category_map(_column, _key, f"m_{_key}"), S.category_baskets(f"m_{_key}", f"cb_{_key}")]
    _manifest_parts.append(
        f"SELECT '{'outfit_category' if _key == 'outfit' else _key}' AS variant FROM cb_{_key}")


_MANIFEST_NAMES = ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in variants.variant_labels())
_YEAR_NAMES = """SELECT variant AS key, 'Year ' || substr(start_day, 1, 4) AS label,
       'Baskets from ' || start_day || ' to ' || end_day AS description FROM year_ranges"""


@query("variant_manifest", S.with_(*_MANIFEST_CTES, "counted AS (SELECT variant, count(*) AS rows FROM ("
       + " UNION ALL ".join(_manifest_parts) + ") GROUP BY variant)", f"""names AS (
  SELECT * FROM (VALUES {_MANIFEST_NAMES}) AS v(key, label, description) UNION ALL {_YEAR_NAMES})""") + """
SELECT key, label, CASE WHEN key = 'base' THEN 'variants' ELSE 'variants/variant=' || key END AS path, description, CAST(rows AS VARCHAR) AS rows
FROM names LEFT JOIN counted ON variant = key WHERE rows IS NOT NULL OR key = 'base'""")
def variant_manifest(spark, sf_dir):
    v = variants.all_variants(basket_arrays(spark, sf_dir), tables.articles_raw(spark, sf_dir),
                              tables.customers(spark, sf_dir), MIN_ITEMS)
    # as text: the base entry has no count
    return variants.variant_manifest(v).withColumn("rows", F.col("rows").cast("string"))


@query("range_baskets", S.with_(S.TX, S.BASKETS, """seasons AS (
  SELECT DISTINCT 'winter_' || substr(t_dat, 1, 4) AS variant, substr(t_dat, 1, 4) || '-11-16' AS start_day,
         CAST(CAST(substr(t_dat, 1, 4) AS INTEGER) + 1 AS VARCHAR) || '-02-15' AS end_day FROM baskets)""") + """
SELECT s.variant, b.transaction_id, b.customer_id, b.t_dat, array_to_string(b.items, ' ') AS items, b.item_count
FROM baskets b JOIN seasons s ON b.t_dat >= s.start_day AND b.t_dat <= s.end_day""")
def range_baskets(spark, sf_dir):
    """Ranges from a table: the winters of the years that have baskets."""
    b = cut_lineage(basket_arrays(spark, sf_dir))
    year = F.substring("t_dat", 1, 4)
    seasons = b.select(year.alias("y")).distinct().select(
        F.concat(F.lit("winter_"), "y").alias("variant"), F.concat("y", F.lit("-11-16")).alias("start"),
        F.concat((F.col("y").cast("int") + 1).cast("string"), F.lit("-02-15")).alias("end"))
    return B_text(variants.year_baskets(b, seasons, MIN_ITEMS))


@query("mining_baskets", S.mining_with() + "SELECT transaction_id, t_dat, array_to_string(items, ' ') AS items "
       "FROM mining_baskets")
def mining_baskets_q(spark, sf_dir):
    return B_text(mining_text_baskets(spark, sf_dir))


# -- grouped mining of every variant (V9) -----------------------------------

VARIANT_SUPPORT, VARIANT_MAX_LEN = 0.01, 3
_VAR_PARTS = ["SELECT variant, transaction_id, string_split(items, ' ') AS items FROM year_b",
              "SELECT variant, transaction_id, string_split(items, ' ') AS items FROM age_b"]
for _key, _column in variants.CATEGORY_VARIANTS + [("outfit", variants.OUTFIT_VARIANT[1])]:
    _VAR_PARTS.append(f"SELECT '{'outfit_category' if _key == 'outfit' else _key}' AS variant, transaction_id, items "
                      f"FROM cb_{_key}")
_VAR_CTES = _MANIFEST_CTES + [
    "var_baskets AS (" + " UNION ALL ".join(_VAR_PARTS) + ")",
    "var_items AS (SELECT variant, transaction_id, unnest(items) AS item FROM var_baskets)",
    *S.itemsets_sql(VARIANT_SUPPORT, VARIANT_MAX_LEN, "var_items", "var_baskets", "vsets", group="variant"),
]


@query("itemsets_by_variant", S.with_(*_VAR_CTES) + "SELECT variant, itemset_key, length, support_count, support "
       "FROM vsets")
def itemsets_by_variant(spark, sf_dir):
    from tillroll.operators.mining import apriori

    v = variants.all_variants(basket_arrays(spark, sf_dir), tables.articles_raw(spark, sf_dir),
                              tables.customers(spark, sf_dir), MIN_ITEMS)
    found = apriori(v.select("variant", "transaction_id", "items"), VARIANT_SUPPORT, VARIANT_MAX_LEN,
                    group_cols=["variant"])
    return found.select("variant", "itemset_key", "length", "support_count", "support")
