"""DuckDB SQL for the named models run over the derived feed (``plans.feed``).

The feed rule is applied in SQL directly to typed columns (no JSON), then
each model is written the way the warehouse models are: flatten, window
``row_number() = 1`` with explicit null order, md5 keys. Each query below is
``WITH <all CTEs> SELECT ...``; unused CTEs cost nothing.
"""

from __future__ import annotations

E = "TIMESTAMP '2011-01-01 00:00:00'"


def _ts(k: str) -> str:
    return f"({E} + to_minutes(CAST({k} AS BIGINT)))"


def _rn(partition: str, order: str) -> str:
    return f"row_number() OVER (PARTITION BY {partition} ORDER BY {order})"


def _d(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS FIRST" for c in cols)


def _price(v: str, div: str, typ: str) -> str:
    return f"CASE WHEN {v} < 0 THEN NULL ELSE CAST({v} / {div} AS {typ}) END"


CTES: list[tuple[str, str]] = [
    ("li", f"""
SELECT 'P' || CAST(l.l_partkey AS VARCHAR) AS asin,
       'L' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS raw_id,
       CAST(l.l_shipdate AS TIMESTAMP) AS extracted_at,
       CAST(l.l_shipdate AS DATE) AS ingest_ts,
       datediff('minute', {E}, l.l_shipdate) AS m,
       l.l_extendedprice / l.l_quantity AS unit,
       (l.l_extendedprice / l.l_quantity) * (1 - l.l_discount) AS net,
       CAST(l.l_quantity AS BIGINT) AS qty,
       CAST(round(p.p_retailprice * 100) AS BIGINT) AS retail,
       l.l_suppkey, l.l_linenumber, l.l_tax, l.l_returnflag, l.l_linestatus,
       p.p_name, p.p_brand, p.p_type, p.p_size
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    # ---- price
    ("price_pts", """
SELECT asin, 'AMAZON' AS price_channel, m AS k, CAST(round(unit * 100) AS BIGINT) AS v, ingest_ts FROM li
UNION ALL SELECT asin, 'AMAZON', m + 1440, CAST(round(net * 100) AS BIGINT), ingest_ts FROM li
UNION ALL SELECT asin, 'NEW', m, CASE WHEN l_returnflag = 'R' THEN -1 ELSE retail END, ingest_ts FROM li
UNION ALL SELECT asin, 'LISTPRICE', m, retail, ingest_ts FROM li"""),
    ("price_clean", f"""
SELECT asin, price_channel, {_ts('k')} AS snapshot_ts,
       {_price('v', '100.0', 'DECIMAL(18,2)')} AS price,
       CASE WHEN v < 0 THEN 1 ELSE 0 END AS was_sentinel, ingest_ts FROM price_pts"""),
    ("stg_price", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, {_rn('asin, price_channel, snapshot_ts', _d('ingest_ts', 'price', 'was_sentinel'))} AS rn
FROM price_clean) WHERE rn = 1"""),
    ("price_daily", f"""
SELECT asin, price_channel, date, price, ingest_ts FROM (
  SELECT *, CAST(snapshot_ts AS DATE) AS date,
         {_rn('asin, price_channel, CAST(snapshot_ts AS DATE)', _d('ingest_ts', 'snapshot_ts'))} AS rn
  FROM stg_price) WHERE rn = 1"""),
    # ---- rank
    ("rank_pts", """
SELECT asin, m AS k, CAST(l_suppkey AS BIGINT) AS v, ingest_ts FROM li
UNION ALL SELECT asin, m + 60, CAST(l_linenumber - 1 AS BIGINT), ingest_ts FROM li
UNION ALL SELECT asin, m + 120, CAST(NULL AS BIGINT), ingest_ts FROM li"""),
    ("stg_rank", f"""
SELECT asin, snapshot_ts, rank, ingest_ts FROM (
  SELECT *, {_rn('asin, snapshot_ts', _d('ingest_ts', 'rank'))} AS rn FROM (
    SELECT asin, {_ts('k')} AS snapshot_ts, CASE WHEN v < 0 THEN NULL ELSE v END AS rank, ingest_ts
    FROM rank_pts)) WHERE rn = 1"""),
    ("rank_daily", f"""
SELECT asin, date, rank FROM (
  SELECT *, CAST(snapshot_ts AS DATE) AS date,
         {_rn('asin, CAST(snapshot_ts AS DATE)', _d('ingest_ts', 'snapshot_ts'))} AS rn FROM stg_rank)
WHERE rn = 1"""),
    # ---- reviews
    ("rating_side", f"""
SELECT asin, k, raw_rating, ingest_ts FROM (
  SELECT asin, m AS k, CAST(round(l_tax * 1000) AS BIGINT) AS raw_rating, ingest_ts,
         {_rn('asin, m', 'ingest_ts DESC NULLS FIRST, CAST(round(l_tax * 1000) AS BIGINT) DESC NULLS FIRST')} AS rn
  FROM li) WHERE rn = 1"""),
    ("count_side", f"""
SELECT asin, k, raw_count, ingest_ts FROM (
  SELECT *, {_rn('asin, k', _d('ingest_ts', 'raw_count'))} AS rn FROM (
    SELECT asin, m AS k, qty AS raw_count, ingest_ts FROM li
    UNION ALL SELECT asin, m + 30, 2 * qty, ingest_ts FROM li)) WHERE rn = 1"""),
    ("stg_reviews", f"""
SELECT asin, snapshot_ts, rating, review_count, ingest_ts FROM (
  SELECT *, {_rn('asin, snapshot_ts', _d('ingest_ts', 'rating', 'review_count'))} AS rn FROM (
    SELECT coalesce(r.asin, c.asin) AS asin, {_ts('coalesce(r.k, c.k)')} AS snapshot_ts,
           {_price('r.raw_rating', '10.0', 'DECIMAL(3,1)')} AS rating,
           CASE WHEN c.raw_count < 0 THEN NULL ELSE c.raw_count END AS review_count,
           coalesce(r.ingest_ts, c.ingest_ts) AS ingest_ts
    FROM rating_side r FULL OUTER JOIN count_side c ON r.asin = c.asin AND r.k = c.k)) WHERE rn = 1"""),
    ("reviews_daily", f"""
SELECT asin, date, rating, review_count FROM (
  SELECT *, CAST(snapshot_ts AS DATE) AS date,
         {_rn('asin, CAST(snapshot_ts AS DATE)', _d('ingest_ts', 'snapshot_ts'))} AS rn FROM stg_reviews)
WHERE rn = 1"""),
    # ---- offers
    ("offers_raw", """
SELECT asin, 'O' || CAST(l_suppkey AS VARCHAR) AS offer_id, 'S' || CAST(l_suppkey AS VARCHAR) AS seller_id,
       l_linestatus = 'O' AS is_prime, l_returnflag = 'A' AS is_fba, l_returnflag AS condition,
       TRUE AS is_shippable, FALSE AS is_map, CAST(round(l_tax * 10000) AS BIGINT) AS shipping,
       concat_ws(',', CAST(m AS VARCHAR), CAST(CAST(round(unit) AS BIGINT) AS VARCHAR),
                 CAST(m + 1440 AS VARCHAR),
                 CAST(CASE WHEN l_returnflag = 'N' THEN -1 ELSE CAST(round(net) AS BIGINT) END AS VARCHAR),
                 CAST(m + 2880 AS VARCHAR), '0') AS offer_csv_raw,
       ingest_ts
FROM li"""),
    ("stg_offers", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, {_rn('asin, offer_id', _d('ingest_ts', 'offer_csv_raw', 'seller_id', 'is_prime', 'is_fba', 'condition', 'is_shippable', 'is_map'))} AS rn
  FROM offers_raw) WHERE rn = 1"""),
    ("stg_offer_metadata", f"""
SELECT md5(asin || '|' || offer_id || '|' || CAST(ingest_ts AS VARCHAR)) AS stg_offer_meta_id,
       asin, offer_id, seller_id, is_prime, is_map, condition_code, shipping_dollars, ingest_ts FROM (
  SELECT *, {_rn('asin, offer_id, ingest_ts', _d('seller_id', 'shipping_dollars', 'condition_code', 'is_prime', 'is_map'))} AS rn
  FROM (SELECT asin, offer_id, seller_id, is_prime, is_map, condition AS condition_code,
               CAST(shipping / 100.0 AS DECIMAL(18,2)) AS shipping_dollars, ingest_ts FROM offers_raw))
WHERE rn = 1"""),
    ("offer_tokens", """
SELECT asin, offer_id, ingest_ts, string_split(offer_csv_raw, ',') AS t FROM offers_raw
WHERE offer_csv_raw IS NOT NULL AND offer_csv_raw <> ''"""),
    ("offer_pairs", """
SELECT asin, offer_id, ingest_ts, TRY_CAST(t[2*j+1] AS DECIMAL(38,0)) AS k,
       TRY_CAST(t[2*j+2] AS DECIMAL(38,0)) AS v
FROM (SELECT *, unnest(range(len(t) // 2)) AS j FROM offer_tokens)"""),
    ("stg_offer_price", f"""
SELECT asin, offer_id, snapshot_ts, price, was_sentinel, ingest_ts FROM (
  SELECT *, {_rn('asin, offer_id, snapshot_ts', _d('ingest_ts', 'price'))} AS rn FROM (
    SELECT asin, offer_id, {_ts('k')} AS snapshot_ts,
           CASE WHEN v < 0 THEN NULL ELSE CAST(v / 100.0 AS DECIMAL(18,2)) END AS price,
           CASE WHEN v < 0 THEN 1 ELSE 0 END AS was_sentinel, ingest_ts
    FROM offer_pairs WHERE v < 0 OR (v > 0 AND v <= 40000))) WHERE rn = 1"""),
    ("offer_price_daily", f"""
SELECT asin, offer_id, date, price FROM (
  SELECT *, CAST(snapshot_ts AS DATE) AS date,
         {_rn('asin, offer_id, CAST(snapshot_ts AS DATE)', _d('ingest_ts', 'snapshot_ts'))} AS rn
  FROM stg_offer_price) WHERE rn = 1"""),
    # ---- buy box
    ("stg_buybox", f"""
SELECT asin, snapshot_ts, seller_id, ingest_ts FROM (
  SELECT *, {_rn('asin, snapshot_ts', _d('ingest_ts', 'seller_id'))} AS rn FROM (
    SELECT asin, {_ts('m')} AS snapshot_ts, 'S' || CAST(l_suppkey AS VARCHAR) AS seller_id, ingest_ts FROM li
    UNION ALL SELECT asin, {_ts('m + 10')}, CAST(NULL AS VARCHAR), ingest_ts FROM li)) WHERE rn = 1"""),
    ("buybox_daily", f"""
SELECT asin, date, seller_id FROM (
  SELECT asin, CAST(snapshot_ts AS DATE) AS date, seller_id,
         {_rn('asin, CAST(snapshot_ts AS DATE)', 'seller_id ASC NULLS LAST')} AS rn FROM stg_buybox)
WHERE rn = 1"""),
    # ---- monthly sales
    ("sales_pts", """
SELECT asin, m AS k, qty AS est, ingest_ts FROM li
UNION ALL SELECT asin, m + 43200, qty + l_linenumber, ingest_ts FROM li
UNION ALL SELECT asin, m + 86400, CAST(NULL AS BIGINT), ingest_ts FROM li"""),
    ("stg_sales", f"""
SELECT asin, sales_month, est_units_sold, ingest_ts FROM (
  SELECT *, {_rn('asin, sales_month', _d('ingest_ts', 'k', 'est_units_sold'))} AS rn FROM (
    SELECT asin, CAST(date_trunc('month', {_ts('k')}) AS DATE) AS sales_month, k, est AS est_units_sold,
           ingest_ts FROM sales_pts WHERE k IS NOT NULL)) WHERE rn = 1"""),
    # ---- product attributes and categories
    ("base_attrs", """
SELECT asin, p_name AS title, p_brand AS brand, p_brand AS manufacturer, p_type AS binding,
       string_split(p_name, ' ')[1] AS color, p_type AS product_group, CAST(p_size AS BIGINT) AS product_type_id,
       lower(p_type) AS website_display_group, p_type AS website_display_group_name,
       p_type, p_size, ingest_ts, extracted_at, raw_id FROM li"""),
    ("product_latest", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, {_rn('asin', _d('ingest_ts', 'extracted_at', 'raw_id'))} AS rn FROM base_attrs) WHERE rn = 1"""),
    ("product_categories", """
SELECT asin, CAST(length(p_type) AS BIGINT) AS category_id, p_type AS category_name,
       CAST(NULL AS BIGINT) AS parent_category_id FROM product_latest
UNION ALL SELECT asin, CAST(100 + p_size AS BIGINT), p_type || '/' || CAST(p_size AS VARCHAR),
       CAST(length(p_type) AS BIGINT) FROM product_latest"""),
    ("stg_category_tree", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, {_rn('asin, category_id, parent_category_id', _d('ingest_ts', 'category_name', 'category_level'))} AS rn FROM (
    SELECT asin, CAST(length(p_type) AS BIGINT) AS category_id, CAST(NULL AS BIGINT) AS parent_category_id,
           CAST(NULL AS BIGINT) AS category_level, p_type AS category_name, ingest_ts FROM li
    UNION ALL SELECT asin, CAST(100 + p_size AS BIGINT), CAST(length(p_type) AS BIGINT), CAST(NULL AS BIGINT),
           p_type || '/' || CAST(p_size AS VARCHAR), ingest_ts FROM li)) WHERE rn = 1"""),
    # ---- videos and A+ content
    ("stg_videos", f"""
SELECT md5(asin || '|' || vk || '|' || strftime(CAST(snapshot_ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S%g'))
           AS stg_video_id,
       asin, snapshot_ts, creator, duration_sec, thumbnail_url, name, title, url FROM (
  SELECT *, {_rn('asin, vk', _d('snapshot_ts', 'title', 'creator', 'duration_sec', 'thumbnail_url', 'name'))} AS rn
  FROM (SELECT asin, ingest_ts AS snapshot_ts, p_brand AS creator,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE qty * 10 END AS duration_sec,
               CAST(NULL AS VARCHAR) AS thumbnail_url, 'clip ' || CAST(l_suppkey AS VARCHAR) AS name,
               p_name AS title,
               CASE WHEN l_linestatus = 'O' THEN 'https://v/' || CAST(l_suppkey AS VARCHAR) END AS url,
               coalesce(CASE WHEN l_linestatus = 'O' THEN 'https://v/' || CAST(l_suppkey AS VARCHAR) END,
                        'clip ' || CAST(l_suppkey AS VARCHAR)) AS vk
        FROM li)) WHERE rn = 1"""),
    ("aplus_assets", """
SELECT asin, 0 AS aplus_idx, 0 AS module_idx, 'image' AS asset_type,
       CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS asset_idx,
       unnest(string_split(p_name, ' ')) AS url, CAST(NULL AS VARCHAR) AS alt_text,
       CAST(NULL AS VARCHAR) AS text, ingest_ts FROM li
UNION ALL SELECT asin, 0, 0, 'image_alt', 0, NULL, p_type, NULL, ingest_ts FROM li
UNION ALL SELECT asin, 0, 0, 'text', NULL, NULL, NULL, NULL, ingest_ts FROM li
UNION ALL SELECT asin, 0, 0, 'video', NULL, NULL, NULL, NULL, ingest_ts FROM li
UNION ALL SELECT asin, 0, 1, t.asset_type, NULL, NULL, NULL, NULL, ingest_ts
  FROM li, (VALUES ('image'), ('image_alt'), ('text'), ('video')) AS t(asset_type)"""),
    ("stg_aplus_module", f"""
SELECT md5(asin || '|' || CAST(aplus_idx AS VARCHAR) || '|' || CAST(module_idx AS VARCHAR) || '|' ||
           asset_type || '|' || CAST(asset_idx AS VARCHAR)) AS stg_aplus_id,
       asin, aplus_idx, module_idx, asset_type, asset_idx, url, alt_text, text, ingest_ts FROM (
  SELECT *, {_rn('asin, aplus_idx, module_idx, asset_type, asset_idx', _d('ingest_ts', 'url', 'alt_text', 'text'))} AS rn
  FROM aplus_assets) WHERE rn = 1"""),
    # ---- quarantines
    ("bad_price", """
SELECT 'price' AS table_name, asin, snapshot_ts, ingest_ts,
       CASE WHEN asin IS NULL THEN 'ASIN_NULL' WHEN snapshot_ts IS NULL THEN 'TS_NULL'
            WHEN price IS NOT NULL AND price < 0 THEN 'PRICE_NEGATIVE' END AS reason_code,
       'Price staging validation failure' AS reason_detail,
       md5(coalesce(asin, 'NULL') || '|' || coalesce(price_channel, 'NULL') || '|' ||
           coalesce(strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S.%g'), 'NULL') || '|' ||
           coalesce(CAST(ingest_ts AS VARCHAR), 'NULL')) AS bad_row_id
FROM stg_price"""),
    ("bad_rank", """
SELECT 'rank' AS table_name, asin, snapshot_ts, ingest_ts,
       CASE WHEN asin IS NULL THEN 'ASIN_NULL' WHEN snapshot_ts IS NULL THEN 'TS_NULL'
            WHEN rank IS NOT NULL AND rank <= 0 THEN 'RANK_NONPOSITIVE' END AS reason_code,
       'Rank staging validation failure' AS reason_detail,
       md5(coalesce(asin, 'NULL') || '|' || coalesce(strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S.%g'), 'NULL')
           || '|' || coalesce(CAST(ingest_ts AS VARCHAR), 'NULL')) AS bad_row_id
FROM stg_rank"""),
    ("bad_reviews", """
SELECT 'reviews' AS table_name, asin, snapshot_ts, ingest_ts,
       CASE WHEN asin IS NULL THEN 'ASIN_NULL' WHEN snapshot_ts IS NULL THEN 'TS_NULL'
            WHEN rating IS NOT NULL AND (rating < 0 OR rating > 5) THEN 'RATING_OOB'
            WHEN review_count IS NOT NULL AND review_count < 0 THEN 'COUNT_NEGATIVE' END AS reason_code,
       'Reviews staging validation failure' AS reason_detail,
       md5(coalesce(asin, 'NULL') || '|' || coalesce(strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S.%g'), 'NULL')
           || '|' || coalesce(CAST(ingest_ts AS VARCHAR), 'NULL')) AS bad_row_id
FROM stg_reviews"""),
    ("bad_offers", """
SELECT 'offers' AS table_name, asin, CAST(NULL AS TIMESTAMP) AS snapshot_ts, ingest_ts,
       CASE WHEN asin IS NULL THEN 'ASIN_NULL' WHEN offer_id IS NULL THEN 'OFFER_ID_NULL'
            WHEN offer_csv_raw IS NULL OR offer_csv_raw = '' THEN 'OFFER_CSV_EMPTY' END AS reason_code,
       'Offers staging validation failure' AS reason_detail,
       md5(coalesce(asin, 'NULL') || '|' || coalesce(offer_id, 'NULL') || '|' ||
           coalesce(CAST(ingest_ts AS VARCHAR), 'NULL')) AS bad_row_id
FROM stg_offers"""),
    ("bad_aplus", """
SELECT 'aplus' AS table_name, asin, CAST(NULL AS TIMESTAMP) AS snapshot_ts, ingest_ts,
       CASE WHEN asin IS NULL THEN 'ASIN_NULL' WHEN asset_count = 0 THEN 'MODULE_EMPTY' END AS reason_code,
       'A+ module empty or asin missing' AS reason_detail,
       md5(coalesce(asin, 'NULL') || '|' || coalesce(CAST(aplus_idx AS VARCHAR), 'NULL') || '|' ||
           coalesce(CAST(module_idx AS VARCHAR), 'NULL') || '|' || coalesce(CAST(ingest_ts AS VARCHAR), 'NULL'))
           AS bad_row_id
FROM (SELECT asin, aplus_idx, module_idx,
             count(*) FILTER (WHERE url IS NOT NULL OR alt_text IS NOT NULL OR text IS NOT NULL) AS asset_count,
             max(ingest_ts) AS ingest_ts
      FROM stg_aplus_module GROUP BY 1, 2, 3)"""),
]

_MS = "strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S.%g')"

FINAL: dict[str, str] = {
    "fct_price_history_daily": "SELECT md5(asin || '|' || price_channel || '|' || CAST(date AS VARCHAR)) AS pk, "
                               "asin, price_channel, date, price FROM price_daily",
    "fct_rank_history_daily": "SELECT md5(asin || '|' || CAST(date AS VARCHAR)) AS pk, asin, date, rank "
                              "FROM rank_daily",
    "fct_review_history_daily": "SELECT md5(asin || '|' || CAST(date AS VARCHAR)) AS pk, asin, date, rating, "
                                "review_count FROM reviews_daily",
    "fct_offer_price_daily": "SELECT md5(coalesce(asin, '_UNKNOWN_ASIN_') || '|' || "
                             "coalesce(offer_id, '_UNKNOWN_OFFER_') || '|' || CAST(date AS VARCHAR)) AS pk, "
                             "asin, offer_id, date, price FROM offer_price_daily WHERE date IS NOT NULL",
    "fct_buybox_history_daily": "SELECT md5(asin || '|' || CAST(date AS VARCHAR) || '|' || "
                                "coalesce(seller_id, 'NULL')) AS pk, asin, date, seller_id FROM buybox_daily",
    "fct_sales_estimate_monthly": "SELECT md5(asin || '|' || CAST(sales_month AS VARCHAR) || "
                                  "'|SALES_ESTIMATE_MONTHLY') AS pk, asin, sales_month, est_units_sold "
                                  "FROM stg_sales WHERE est_units_sold IS NOT NULL AND est_units_sold >= 0",
    "dim_product": "SELECT asin, brand, binding, color, website_display_group, website_display_group_name "
                   "FROM product_latest",
    "dim_product_enriched": "SELECT asin, title, brand, manufacturer, binding, color, product_group, "
                            "product_type_id, website_display_group, website_display_group_name "
                            "FROM product_latest",
    "dim_category": "SELECT category_id, category_name, parent_category_id FROM ("
                    "SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY category_name ASC NULLS LAST, "
                    "parent_category_id ASC NULLS LAST) AS rn FROM product_categories "
                    "WHERE category_id IS NOT NULL) WHERE rn = 1",
    "dim_product_category": "SELECT md5(asin || '|' || CAST(category_id AS VARCHAR)) AS pk, asin, category_id "
                            "FROM product_categories WHERE category_id IS NOT NULL",
    "dim_seller": "SELECT DISTINCT seller_id FROM stg_offers WHERE seller_id IS NOT NULL",
    "core_offer_enriched": "SELECT p.asin, p.offer_id, CAST(p.snapshot_ts AS DATE) AS date, p.price, m.seller_id, "
                           "m.is_prime, m.is_map, m.condition_code, m.shipping_dollars FROM stg_offer_price p "
                           "LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asin, offer_id "
                           "ORDER BY ingest_ts DESC NULLS FIRST, stg_offer_meta_id DESC NULLS FIRST) AS rn "
                           "FROM stg_offer_metadata) WHERE rn = 1) m ON p.asin = m.asin AND p.offer_id = m.offer_id",
    "core_category_hierarchy": "SELECT asin, category_id, parent_category_id, category_level, category_name FROM ("
                               "SELECT *, row_number() OVER (PARTITION BY asin, category_id ORDER BY "
                               "ingest_ts DESC NULLS FIRST, parent_category_id DESC NULLS FIRST, "
                               "category_name DESC NULLS FIRST, category_level DESC NULLS FIRST) AS rn "
                               "FROM stg_category_tree) WHERE rn = 1",
    "stg_base": "SELECT md5(asin || '|' || CAST(ingest_ts AS VARCHAR) || '|' || raw_id) AS stg_row_id, asin, p_name AS title, "
                "p_brand AS brand, CAST(p_size AS BIGINT) AS product_type_id, qty AS monthly_sold, 0 AS csv_text_values, "
                "raw_id AS _airbyte_raw_id, ingest_ts FROM li",
    "stg_price": f"SELECT md5(asin || '|' || price_channel || '|' || {_MS}) AS pk, * FROM stg_price",
    "stg_rank": f"SELECT md5(asin || '|' || {_MS}) AS pk, * FROM stg_rank",
    "stg_reviews": f"SELECT md5(asin || '|' || {_MS}) AS pk, * FROM stg_reviews",
    "stg_offers": "SELECT md5(asin || '|' || offer_id) AS stg_offer_id, asin, offer_id, seller_id, is_prime, is_fba, condition, "
                  "is_shippable, is_map, offer_csv_raw, ingest_ts FROM stg_offers",
    "stg_offer_price": f"SELECT md5(asin || '|' || offer_id || '|' || {_MS}) AS stg_offer_price_id, * FROM stg_offer_price",
    "stg_buybox_history": f"SELECT md5(asin || '|' || {_MS} || '|' || coalesce(seller_id, 'NULL')) AS stg_buybox_row_id, * "
                          "FROM stg_buybox",
    "stg_category_tree": "SELECT md5(coalesce(asin, 'NULL') || '|' || coalesce(CAST(category_id AS VARCHAR), 'NULL') || '|' || "
                         "coalesce(CAST(parent_category_id AS VARCHAR), 'NULL')) AS stg_category_row_id, * FROM stg_category_tree",
    "stg_product_metadata": "SELECT md5(asin || '|' || CAST(ingest_ts AS VARCHAR)) AS stg_product_meta_id, asin, title, brand, "
                            "manufacturer, binding, color, product_group, product_type_id, website_display_group, "
                            "website_display_group_name, ingest_ts FROM (SELECT *, row_number() OVER (PARTITION BY asin, ingest_ts "
                            "ORDER BY extracted_at DESC NULLS FIRST, raw_id DESC NULLS FIRST) AS rn FROM base_attrs) WHERE rn = 1",
    "stg_sales_monthly_stats": "SELECT md5(asin || '|' || CAST(sales_month AS VARCHAR)) AS stg_sales_stats_id, * FROM stg_sales",
    "stg_rank__bad": "SELECT md5(coalesce(asin, 'NULL') || '|' || coalesce(" + _MS + ", 'NULL') || '|' || "
                     "coalesce(CAST(ingest_ts AS VARCHAR), 'NULL')) AS bad_row_id, asin, snapshot_ts, rank, ingest_ts, "
                     "'RANK_NONPOSITIVE' AS reason_code, 'Rank staging validation failure' AS reason_detail "
                     "FROM stg_rank WHERE rank <= 0",
    "core_rank_daily": "SELECT md5(asin || '|' || CAST(date AS VARCHAR)) AS pk, asin, date, rank, ingest_ts FROM ("
                       "SELECT *, CAST(snapshot_ts AS DATE) AS date, row_number() OVER (PARTITION BY asin, CAST(snapshot_ts AS DATE) "
                       "ORDER BY ingest_ts DESC NULLS FIRST, snapshot_ts DESC NULLS FIRST) AS rn FROM stg_rank) WHERE rn = 1",
    "core_price_daily": "SELECT md5(asin || '|' || price_channel || '|' || CAST(date AS VARCHAR)) AS pk, * FROM price_daily",
    "core_buybox_daily": "SELECT asin, date, seller_id FROM buybox_daily",
    "core_product_categories": "SELECT asin, category_id, category_name, parent_category_id FROM product_categories",
    "core_product_enriched": "SELECT asin, title, brand, manufacturer, binding, color, product_group, product_type_id, "
                             "website_display_group, website_display_group_name FROM product_latest",
    "core_sales_estimate_monthly": "SELECT asin, sales_month, est_units_sold FROM stg_sales",
    "core_reviews_daily": "SELECT md5(asin || '|' || CAST(date AS VARCHAR)) AS pk, asin, date, rating, review_count, ingest_ts FROM ("
                          "SELECT *, CAST(snapshot_ts AS DATE) AS date, row_number() OVER (PARTITION BY asin, CAST(snapshot_ts AS DATE) "
                          "ORDER BY ingest_ts DESC NULLS FIRST, snapshot_ts DESC NULLS FIRST) AS rn FROM stg_reviews) WHERE rn = 1",
    "core_offer_price_daily": "SELECT md5(asin || '|' || offer_id || '|' || CAST(date AS VARCHAR)) AS pk, asin, offer_id, date, price, ingest_ts "
                              "FROM (SELECT *, CAST(snapshot_ts AS DATE) AS date, row_number() OVER (PARTITION BY asin, offer_id, "
                              "CAST(snapshot_ts AS DATE) ORDER BY ingest_ts DESC NULLS FIRST, snapshot_ts DESC NULLS FIRST) AS rn "
                              "FROM stg_offer_price) WHERE rn = 1",
    "core_product_latest": "SELECT asin, brand, binding, color, website_display_group, website_display_group_name, "
                           "'[{\"catId\":' || length(p_type) || ',\"name\":\"' || p_type || '\"},{\"catId\":' || (100 + p_size) || "
                           "',\"name\":\"' || p_type || '/' || p_size || '\"}]' AS category_tree_v FROM product_latest",
    "stg_videos": "SELECT * FROM stg_videos",
    "stg_aplus_module": "SELECT * FROM stg_aplus_module",
    "stg_offer_metadata": "SELECT * FROM stg_offer_metadata",
    "stg_quarantine_rollup": "SELECT table_name, bad_row_id, asin, snapshot_ts, reason_code, reason_detail, "
                             "ingest_ts FROM (SELECT * FROM bad_price UNION ALL SELECT * FROM bad_rank "
                             "UNION ALL SELECT * FROM bad_reviews UNION ALL SELECT * FROM bad_offers "
                             "UNION ALL SELECT * FROM bad_aplus) WHERE reason_code IS NOT NULL",
}


# The odd feed differs in three expressions (see ``plans.feed.odd_feed``).
ODD = (
    ("li", "'P' || CAST(l.l_partkey AS VARCHAR) AS asin", "CASE WHEN l.l_linenumber <> 7 THEN 'P' || CAST(l.l_partkey AS VARCHAR) END AS asin"),
    ("offers_raw", "'O' || CAST(l_suppkey AS VARCHAR) AS offer_id",
     "CASE WHEN CAST(round(l_tax * 10000) AS BIGINT) <> 0 THEN 'O' || CAST(l_suppkey AS VARCHAR) END AS offer_id"),
    ("offers_raw", "       concat_ws(',', CAST(m AS VARCHAR), CAST(CAST(round(unit) AS BIGINT) AS VARCHAR),",
     "       CASE WHEN l_linenumber = 6 THEN '' ELSE concat_ws(',', CAST(m AS VARCHAR), CAST(CAST(round(unit) AS BIGINT) AS VARCHAR),"),
    ("offers_raw", "CAST(m + 2880 AS VARCHAR), '0') AS offer_csv_raw", "CAST(m + 2880 AS VARCHAR), '0') END AS offer_csv_raw"),
)


# Quarantines with their kept columns: (CTE, the head that the roll-up selects, the columns).
ODD_BAD = {
    "stg_price__bad": ("bad_price", "SELECT 'price' AS table_name, asin, snapshot_ts, ingest_ts,",
                       "asin, price_channel, snapshot_ts, price, was_sentinel, ingest_ts"),
    "stg_reviews__bad": ("bad_reviews", "SELECT 'reviews' AS table_name, asin, snapshot_ts, ingest_ts,",
                         "asin, snapshot_ts, rating, review_count, ingest_ts"),
    "stg_offers__bad": ("bad_offers", "SELECT 'offers' AS table_name, asin, CAST(NULL AS TIMESTAMP) AS snapshot_ts, ingest_ts,",
                        "asin, offer_id, seller_id, offer_csv_raw, ingest_ts"),
    "stg_aplus_module__bad": ("bad_aplus", "SELECT 'aplus' AS table_name, asin, CAST(NULL AS TIMESTAMP) AS snapshot_ts, ingest_ts,",
                              "asin, aplus_idx, module_idx, asset_count, ingest_ts"),
}


def _with(ctes) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


def feed_oracles() -> dict[str, str]:
    out = {k: f"{_with(CTES)}\n{sql}" for k, sql in FINAL.items()}
    odd = dict(CTES)
    for name, plain, other in ODD:
        assert plain in odd[name], (name, plain)
        odd[name] = odd[name].replace(plain, other)
    out.update({f"ndjson_{k}": out[k] for k in ("fct_price_history_daily", "fct_review_history_daily", "stg_videos", "stg_offer_metadata",
                                                "stg_aplus_module")})
    for name, (cte, head, columns) in ODD_BAD.items():
        assert head in odd[cte], cte
        out[f"{name}_odd_feed"] = (f"{_with(odd.items())}\nSELECT bad_row_id, {columns}, reason_code, reason_detail FROM ("
                                   f"{odd[cte].replace(head, 'SELECT *,', 1)}) WHERE reason_code IS NOT NULL")
    out["quarantine_rollup_odd_feed"] = f"{_with(odd.items())}\n{FINAL['stg_quarantine_rollup']}"
    return out
