"""DuckDB building blocks for the oracle SQL (views of the driver tables)."""

from __future__ import annotations


def zfill(x: str) -> str:
    return f"(CASE WHEN length({x}) >= 10 THEN {x} ELSE lpad({x}, 10, '0') END)"


def safe_token(x: str) -> str:
    inner = f"trim(regexp_replace(lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"coalesce(nullif({inner}, ''), 'unknown')"


TX = """tx AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS t_dat,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS article_id,
         l_extendedprice AS price,
         CAST(l_linenumber AS INTEGER) AS sales_channel_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ARTICLES = """articles AS (
  SELECT CAST(p_partkey AS VARCHAR) AS article_id, p_name AS prod_name, p_type AS product_type_name,
         p_brand AS product_group_name, concat_ws(' ', p_brand, p_type) AS department_name,
         'Size ' || CAST(p_size AS VARCHAR) AS section_name, p_type AS garment_group_name
  FROM part)"""

ARTICLES_WIDE = """articles_wide AS (
  SELECT CAST(p_partkey AS VARCHAR) AS article_id, p_name AS prod_name, p_type AS product_type_name,
         p_brand AS product_group_name, p_type AS graphical_appearance_name,
         split_part(p_name, ' ', 1) AS colour_group_name,
         concat_ws(' ', p_brand, p_type) AS department_name,
         'Size ' || CAST(p_size AS VARCHAR) AS section_name, p_type AS garment_group_name,
         p_name AS detail_desc
  FROM part)"""

CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(16 + c_custkey % 60 AS DOUBLE) END AS age,
         c_mktsegment AS club_member_status,
         CASE WHEN c_acctbal >= 0 THEN 'Regularly' ELSE 'NONE' END AS fashion_news_frequency
  FROM customer)"""

BASKETS = f"""baskets AS (
  SELECT customer_id || '_' || t_dat AS transaction_id, customer_id, t_dat, items,
         CAST(len(items) AS BIGINT) AS item_count
  FROM (SELECT customer_id, t_dat, list_sort(list(DISTINCT {zfill('article_id')})) AS items
        FROM tx
        WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL
        GROUP BY customer_id, t_dat)
  WHERE len(items) >= 2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def parse_items(x: str, pad: bool = True) -> str:
    cleaned = f"regexp_replace({x}, '^[\\[\\]]+|[\\[\\]]+$', '', 'g')"
    by_comma = (f"list_transform(list_filter(string_split({cleaned}, ','), lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g') <> ''), "
                f"lambda p: regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '^[''\"]+|[''\"]+$', '', 'g'))")
    by_space = f"list_filter(string_split_regex({cleaned}, '\\s+'), lambda p: p <> '')"
    items = f"(CASE WHEN contains({cleaned}, ',') THEN {by_comma} ELSE {by_space} END)"
    if pad:
        items = f"list_transform({items}, lambda p: {zfill('p')})"
    return f"(CASE WHEN {x} IS NULL THEN []::VARCHAR[] ELSE {items} END)"


BASKETS_TEXT = """baskets_text AS (
  SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items, item_count FROM baskets)"""

BASKET_ITEMS = """basket_items AS (
  SELECT transaction_id, customer_id, t_dat, unnest(items) AS item FROM baskets)"""


def category_map(column: str, prefix: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {zfill('article_id')} AS article_id,
         max('{prefix}_' || {safe_token(f"coalesce({column}, 'unknown')")}) AS category
  FROM articles GROUP BY 1)"""


def category_baskets(map_name: str, name: str, min_items: int = 2) -> str:
    return f"""{name} AS (
  SELECT transaction_id, customer_id, t_dat, items, CAST(len(items) AS BIGINT) AS item_count
  FROM (SELECT bi.transaction_id, bi.customer_id, bi.t_dat, list_sort(list(DISTINCT m.category)) AS items
        FROM basket_items bi JOIN {map_name} m ON m.article_id = bi.item
        GROUP BY 1, 2, 3)
  WHERE len(items) >= {min_items})"""


AGE_GROUPS = """age_groups AS (
  SELECT customer_id,
         CASE max(g) WHEN 0 THEN 'age_under_25' WHEN 1 THEN 'age_25_34' WHEN 2 THEN 'age_35_44'
                     WHEN 3 THEN 'age_45_plus' END AS age_group
  FROM (SELECT customer_id,
               CASE WHEN CAST(trunc(age) AS INTEGER) BETWEEN 0 AND 24 THEN 0
                    WHEN CAST(trunc(age) AS INTEGER) BETWEEN 25 AND 34 THEN 1
                    WHEN CAST(trunc(age) AS INTEGER) BETWEEN 35 AND 44 THEN 2
                    WHEN CAST(trunc(age) AS INTEGER) BETWEEN 45 AND 200 THEN 3 END AS g
        FROM customers WHERE age IS NOT NULL)
  WHERE g IS NOT NULL GROUP BY customer_id)"""

# one closed range per calendar year that has a basket
YEAR_RANGES = """year_ranges AS (
  SELECT DISTINCT 'year_' || substr(t_dat, 1, 4) AS variant, substr(t_dat, 1, 4) || '-01-01' AS start_day,
         substr(t_dat, 1, 4) || '-12-31' AS end_day FROM baskets WHERE item_count >= 2)"""

# mining input: product-group roll-up of the article baskets, loaded whole
MINING_CTES = [
    category_map("product_group_name", "product_group", "pg_map"),
    category_baskets("pg_map", "pg_baskets"),
]
MINING_BASKETS = f"""mining_baskets AS (
  SELECT transaction_id, t_dat, items FROM (
    SELECT transaction_id, t_dat, list_sort(list_distinct({parse_items("array_to_string(items, ' ')")})) AS items
    FROM pg_baskets) WHERE len(items) >= 2)"""
MINING_ITEMS = """mining_items AS (SELECT transaction_id, unnest(items) AS item FROM mining_baskets)"""


def mining_with(*more: str) -> str:
    return with_(TX, ARTICLES, BASKETS, BASKET_ITEMS, *MINING_CTES, MINING_BASKETS, MINING_ITEMS, *more)


def itemsets_sql(support: float, max_len: int = 3, items: str = "mining_items", baskets: str = "mining_baskets",
                 name: str = "itemsets", group: str | None = None) -> list[str]:
    """Frequent itemsets of length 1..max_len (<= 4) by k-way self-joins on
    the basket key; ``group`` mines every group with its own n."""
    gsel = f"{group}, " if group else ""
    gon = lambda a, b: f" AND {a}.{group} = {b}.{group}" if group else ""
    n_cte = (f"{name}_n AS (SELECT {gsel}CAST(count(*) AS DOUBLE) AS n, "
             f"ceil(CAST({support!r} AS DOUBLE) * CAST(count(*) AS DOUBLE)) AS thr FROM {baskets}"
             + (f" GROUP BY {group})" if group else ")"))
    ctes = [n_cte]
    cols = ["x1", "x2", "x3", "x4"][:max_len]
    for k in range(1, max_len + 1):
        xs = cols[:k]
        joins = f"{items} {xs[0]}"
        for i in range(1, k):
            joins += (f" JOIN {items} {xs[i]} ON {xs[i]}.transaction_id = {xs[0]}.transaction_id"
                      f"{gon(xs[i], xs[0])} AND {xs[i - 1]}.item < {xs[i]}.item")
        prev = ""
        if k > 1:
            tup = ", ".join(f"{x}.item" for x in xs[:-1])
            prev_cols = ", ".join(f"i{j}" for j in range(1, k))
            gp = f"{xs[0]}.{group}, " if group else ""
            prev = f" WHERE ({gp}{tup}) IN (SELECT ({gsel}{prev_cols}) FROM {name}_{k - 1})"
        sel = ", ".join(f"{x}.item AS i{j + 1}" for j, x in enumerate(xs))
        gcol = f"{xs[0]}.{group} AS {group}, " if group else ""
        grp = ", ".join(str(j) for j in range(1, k + 1 + (1 if group else 0)))
        thr_join = f"JOIN {name}_n t ON t.{group} = {xs[0]}.{group}" if group else f"CROSS JOIN {name}_n t"
        ctes.append(f"""{name}_{k} AS (SELECT {gcol}{sel}, count(*) AS c, max(t.thr) AS thr
          FROM {joins} {thr_join}{prev}
          GROUP BY {grp} HAVING count(*) >= max(t.thr))""")
    parts = []
    for k in range(1, max_len + 1):
        key = " || ' ' || ".join(f"i{j}" for j in range(1, k + 1))
        parts.append(f"SELECT {gsel}{key} AS itemset_key, {k} AS length, c FROM {name}_{k}")
    on = f"USING ({group})" if group else "ON TRUE"
    ctes.append(f"""{name} AS (
  SELECT {('u.' + group + ', ') if group else ''}itemset_key, string_split(itemset_key, ' ') AS items,
         CAST(length AS INTEGER) AS length, CAST(c AS BIGINT) AS support_count,
         CAST(c AS DOUBLE) / nn.n AS support
  FROM ({' UNION ALL '.join(parts)}) u JOIN {name}_n nn {on})""")
    return ctes


def itemsets_upto3(support: float, items: str = "mining_items", baskets: str = "mining_baskets",
                   name: str = "itemsets", max_len: int = 3) -> list[str]:
    return itemsets_sql(support, max_len, items, baskets, name)


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), "
            f"lambda p: upper(p[1]) || lower(p[2:])), '')")


def readable_token(x: str) -> str:
    stripped = (f"(CASE WHEN starts_with({x}, 'product_group_') THEN substr({x}, 15) "
                f"WHEN starts_with({x}, 'garment_group_') THEN substr({x}, 15) "
                f"WHEN starts_with({x}, 'section_') THEN substr({x}, 9) "
                f"WHEN starts_with({x}, 'outfit_') THEN substr({x}, 8) ELSE {x} END)")
    return title_case(f"replace({stripped}, '_', ' ')")


def rules_sql(itemsets: str, min_conf: float, name: str = "rules") -> list[str]:
    return [
        f"""{name}_masks AS (SELECT items, support AS s_ac, unnest(range(1, (1 << length) - 1)) AS m
          FROM {itemsets} WHERE length >= 2)""",
        f"""{name}_split AS (SELECT s_ac,
            list_filter(items, lambda x, j: ((m >> (j - 1)) & 1) = 1) AS ant,
            list_filter(items, lambda x, j: ((m >> (j - 1)) & 1) = 0) AS con FROM {name}_masks)""",
        f"""{name}_raw AS (SELECT array_to_string(s.ant, ' ') AS antecedents, array_to_string(s.con, ' ') AS consequents,
            s.ant AS antecedent_items, s.con AS consequent_items,
            s.s_ac, a.support AS s_a, c.support AS s_c, s.s_ac / a.support AS confidence
          FROM {name}_split s JOIN {itemsets} a ON a.itemset_key = array_to_string(s.ant, ' ')
                              JOIN {itemsets} c ON c.itemset_key = array_to_string(s.con, ' '))""",
        f"""{name} AS (SELECT antecedents, consequents, antecedent_items, consequent_items,
            s_ac AS support, confidence, confidence / s_c AS lift,
            CAST(len(antecedent_items) + len(consequent_items) AS INTEGER) AS rule_length,
            s_a AS antecedent_support, s_c AS consequent_support,
            s_ac - s_a * s_c AS leverage,
            CASE WHEN confidence < 1 THEN (1 - s_c) / (1 - confidence) ELSE 'inf'::DOUBLE END AS conviction,
            CASE WHEN greatest(s_ac * (1 - s_a), s_a * (s_c - s_ac)) = 0 THEN 0.0
                 ELSE (s_ac - s_a * s_c) / greatest(s_ac * (1 - s_a), s_a * (s_c - s_ac)) END AS zhangs_metric,
            s_ac / (s_a + s_c - s_ac) AS jaccard,
            CASE WHEN 1 - s_c = 0 THEN 0.0 ELSE (confidence - s_c) / (1 - s_c) END AS certainty,
            (s_ac / s_a + s_ac / s_c) / 2 AS kulczynski
          FROM {name}_raw WHERE confidence >= CAST({min_conf!r} AS DOUBLE))""",
    ]


GARMENT_CTES = [
    category_map("garment_group_name", "garment_group", "gg_map"),
    category_baskets("gg_map", "gg_baskets"),
    f"""garment_baskets AS (
  SELECT transaction_id, t_dat, items FROM (
    SELECT transaction_id, t_dat, list_sort(list_distinct({parse_items("array_to_string(items, ' ')")})) AS items
    FROM gg_baskets) WHERE len(items) >= 2)""",
    "garment_items AS (SELECT transaction_id, unnest(items) AS item FROM garment_baskets)",
]
