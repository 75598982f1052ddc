"""Independent SQL for the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

import re

RAW = [
    "platform", "external_product_id", "product_name", "category", "brand", "currency", "price", "original_price",
    "discount_percent", "rating", "review_count", "sold_count", "seller_name", "product_url", "image_url",
    "collected_at", "source_updated_at", "ingestion_timestamp", "raw_source",
]


def _money(cents: str) -> str:
    return f"(CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"


def _ties(skip: set[str], columns: list[str] = RAW) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns if c not in skip)


def _amount(value: str) -> str:
    return f"('฿ ' || format('{{:,.2f}}', {value}))"


_LINK = "('/shop/productdetail/A' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'))"

# Named subqueries; a query pulls in the ones it mentions.
PARTS: dict[str, str] = {
    "lines": """
SELECT l.*, p.*, ['ebay', 'rakuten', 'stockx', 'etsy', 'advice_th'][CAST(l_suppkey % 5 AS INT) + 1] AS source,
  CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS cents,
  CAST(round(l_discount * 100) AS BIGINT) AS disc,
  l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) AS seen_at
FROM lineitem l JOIN part p ON l_partkey = p_partkey""",
    "raw": f"""
SELECT source,
  CASE WHEN l_linenumber = 3 THEN '  ' || upper(source) || ' ' WHEN l_linenumber = 5 THEN ' ' ELSE source END AS platform,
  CASE WHEN l_partkey % 13 = 0 AND l_linenumber = 1 THEN '  ' WHEN l_linenumber = 2
    THEN ' ' || CAST(l_partkey AS VARCHAR) || ' ' ELSE CAST(l_partkey AS VARCHAR) END AS external_product_id,
  CASE WHEN l_partkey % 13 = 5 AND l_linenumber = 4 THEN '   ' ELSE p_name END AS product_name,
  CASE WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS category,
  p_brand AS brand,
  CASE source WHEN 'ebay' THEN 'USD' WHEN 'rakuten' THEN 'JPY' WHEN 'etsy' THEN 'GBP' WHEN 'advice_th' THEN 'THB' END
    AS currency,
  CASE WHEN source = 'stockx' THEN NULL WHEN l_partkey % 13 = 7 AND l_linenumber = 1 THEN 'abc'
    WHEN l_linenumber = 6 THEN '-1.00' ELSE {_money('cents')} END AS price,
  CASE WHEN source <> 'stockx' THEN {_money('cents * 100 // (100 - disc)')} END AS original_price,
  CAST(disc AS DOUBLE) AS discount_percent,
  CASE WHEN l_linenumber = 7 THEN CAST(5.5 AS DOUBLE) ELSE CAST(p_size % 11 AS DOUBLE) / 2 END AS rating,
  CASE WHEN l_linenumber = 6 AND p_size % 5 = 0 THEN CAST(-5 AS BIGINT) ELSE CAST(p_size * 40 AS BIGINT) END AS review_count,
  CAST(l_quantity AS BIGINT) AS sold_count,
  'Supplier ' || CAST(l_suppkey AS VARCHAR) AS seller_name,
  'https://shop.example/' || source || '/' || CAST(l_partkey AS VARCHAR) AS product_url,
  CASE WHEN l_partkey % 13 = 9 AND l_linenumber = 1 THEN 'not a time'
    ELSE strftime(seen_at, '%Y-%m-%d %H:%M:%S') END AS collected_at,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS source_updated_at,
  strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp,
  'batch_' || l_returnflag AS raw_source
FROM lines""",
    "std": """
SELECT coalesce(nullif(lower(trim(platform)), ''), source) AS platform,
  trim(external_product_id) AS external_product_id, trim(product_name) AS product_name, trim(category) AS category,
  trim(brand) AS brand, trim(currency) AS currency,
  CASE WHEN TRY_CAST(price AS DOUBLE) >= 0 THEN TRY_CAST(price AS DOUBLE) END AS price,
  CASE WHEN TRY_CAST(original_price AS DOUBLE) >= 0 THEN TRY_CAST(original_price AS DOUBLE) END AS original_price,
  discount_percent,
  CASE WHEN rating BETWEEN 0 AND 5 THEN rating END AS rating,
  CASE WHEN review_count >= 0 THEN review_count END AS review_count,
  CASE WHEN sold_count >= 0 THEN sold_count END AS sold_count,
  trim(seller_name) AS seller_name, trim(product_url) AS product_url, CAST(NULL AS VARCHAR) AS image_url,
  TRY_CAST(collected_at AS TIMESTAMP) AS collected_at, TRY_CAST(source_updated_at AS TIMESTAMP) AS source_updated_at,
  TRY_CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp, trim(raw_source) AS raw_source,
  CAST(TRY_CAST(collected_at AS TIMESTAMP) AS DATE) AS observation_date
FROM raw""",
    "valid": """
SELECT * FROM std WHERE trim(external_product_id) <> '' AND trim(product_name) <> '' AND observation_date IS NOT NULL""",
    "daily": f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY platform, external_product_id, observation_date
  ORDER BY collected_at DESC NULLS LAST, {_ties({'platform', 'external_product_id'})}) AS rn FROM valid) WHERE rn = 1""",
    "silver": """
SELECT source AS source_system, external_product_id AS product_id, product_name, TRY_CAST(price AS DOUBLE) AS price,
  currency FROM raw""",
    # Warehouse
    "platforms": """
SELECT * FROM (VALUES (1, 'internal', 'internal'), (2, 'ebay', 'marketplace'), (3, 'rakuten', 'marketplace'),
  (4, 'stockx', 'marketplace'), (5, 'etsy', 'marketplace'), (6, 'advice_th', 'marketplace'),
  (7, 'amazon_2023', 'marketplace')) t(platform_key, platform_name, platform_type)""",
    "titles": """
SELECT CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN repeat(CAST(p_partkey AS VARCHAR), 300)
    ELSE 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS source_product_id,
  CASE WHEN n = 0 THEN p_name || ' ' || p_type ELSE p_name END AS product_name,
  CASE WHEN p_size = 3 THEN '' ELSE p_type END AS category, p_brand AS brand
FROM part, (VALUES (0), (1)) v(n)""",
    "best_titles": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_product_id
  ORDER BY length(product_name) DESC, product_name, category, brand) AS rn
  FROM titles WHERE length(source_product_id) BETWEEN 1 AND 255 AND length(product_name) > 0) WHERE rn = 1""",
    "product_rows": f"""
SELECT 1 AS step, s.*, f.created_at FROM (SELECT platform AS source_system, external_product_id AS source_product_id,
    product_name, category, brand, CAST(NULL AS VARCHAR) AS sku FROM (SELECT *, row_number() OVER (
      PARTITION BY platform, external_product_id
      ORDER BY collected_at DESC NULLS LAST, product_name, category, brand) AS rn FROM daily) WHERE rn = 1) s
  JOIN (SELECT platform AS source_system, external_product_id AS source_product_id, min(collected_at) AS created_at
    FROM daily GROUP BY ALL) f USING (source_system, source_product_id)
UNION ALL SELECT 2, 'internal', CAST(p_partkey AS VARCHAR), p_name, p_type, p_brand, 'SKU-' || p_partkey,
  TIMESTAMP '2026-01-01' FROM part
UNION ALL SELECT 3, 'amazon_2023', source_product_id, product_name, nullif(category, ''), nullif(brand, ''), NULL,
  TIMESTAMP '2026-01-01' FROM best_titles""",
    "products": """
SELECT row_number() OVER (ORDER BY step, substr(md5(source_system || '|' || source_product_id), 1, 3), source_system,
  source_product_id) AS product_key, * EXCLUDE (step), CAST(NULL AS TIMESTAMP) AS updated_at FROM product_rows""",
    "customers_src": """
SELECT c_custkey AS source_customer_id, c_name AS customer_code, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CAST(8 + c_custkey % 115 AS INT) AS age, n_name AS province, r_name AS region,
  TIMESTAMP '2020-01-01' + to_days(c_nationkey) AS registered_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
SELECT row_number() OVER (ORDER BY substr(md5(CAST(source_customer_id AS VARCHAR)), 1, 3), source_customer_id)
  AS customer_key, * FROM customers_src""",
    "days": """
SELECT DISTINCT observation_date AS full_date FROM daily
UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL""",
    "dates": """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date FROM days""",
    "facts": """
SELECT row_number() OVER (ORDER BY substr(md5(date_key || '|' || product_key || '|' || platform_key), 1, 4), date_key,
  product_key, platform_key) AS external_fact_key, * FROM (
  SELECT CAST(strftime(observation_date, '%Y%m%d') AS INT) AS date_key, product_key, platform_key, currency,
    CAST(price AS DECIMAL(18,4)) AS price, CAST(original_price AS DECIMAL(18,4)) AS original_price,
    CAST(discount_percent AS DECIMAL(10,4)) AS discount_percent, CAST(rating AS DECIMAL(5,2)) AS rating,
    review_count, sold_count, seller_name, d.product_url, collected_at, TIMESTAMP '2026-01-01' AS processed_at,
    TIMESTAMP '2026-01-01' AS loaded_at
  FROM daily d JOIN platforms ON platform_name = platform
  JOIN products ON source_system = platform AND source_product_id = external_product_id)""",
    "items": f"""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(l_quantity AS INT) AS quantity, CAST({_money('cents')} AS DECIMAL(12,2)) AS unit_price,
  CAST({_money('cents * disc // 100')} AS DECIMAL(12,2)) AS discount_amount,
  CAST({_money('(cents - cents * disc // 100) * CAST(l_quantity AS BIGINT)')} AS DECIMAL(14,2)) AS line_total
FROM lines""",
    "shop_orders": f"""
SELECT o_orderkey AS order_id, 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_number,
  o_custkey AS customer_id, o_orderdate AS order_date, o_orderpriority AS payment_method,
  CASE o_orderkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS sales_channel,
  o_orderstatus AS order_status, CAST({_money('CAST(round(o_totalprice * 100) AS BIGINT)')} AS DECIMAL(14,2)) AS total_amount
FROM orders""",
    "sales_lines": """
SELECT o.* EXCLUDE (total_amount), i.* EXCLUDE (order_id) FROM shop_orders o JOIN items i ON o.order_id = i.order_id""",
    "sales_keyed": """
SELECT l.*, p.product_key, c.customer_key, 1 AS platform_key, CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_key
FROM sales_lines l JOIN products p ON p.source_system = 'internal' AND p.source_product_id = CAST(l.product_id AS VARCHAR)
LEFT JOIN customers c ON c.source_customer_id = l.customer_id""",
    "sales": """
SELECT row_number() OVER (ORDER BY substr(md5(order_id || '|' || product_key), 1, 4), order_id, product_key) AS sales_key,
  order_id, order_number, date_key, product_key, customer_key, platform_key, quantity, unit_price, discount_amount,
  line_total, payment_method, sales_channel, order_status FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_key ORDER BY order_item_id DESC, unit_price DESC,
      customer_id, order_number, order_date, payment_method, sales_channel, order_status, product_id, quantity,
      discount_amount, line_total) AS rn FROM sales_keyed) WHERE rn = 1""",
    "snapshot": """
SELECT platform_name AS marketplace, full_date AS observation_date, currency, source_product_id, product_name, category,
  brand, price, original_price, discount_percent, rating, review_count, sold_count, seller_name, product_url, collected_at,
  processed_at, loaded_at
FROM facts JOIN platforms USING (platform_key) JOIN dates USING (date_key) JOIN products USING (product_key)
WHERE platform_type <> 'internal'""",
    "latest": """
SELECT DISTINCT ON (product_key, platform_key) * FROM facts
ORDER BY product_key, platform_key, collected_at DESC NULLS LAST, external_fact_key DESC""",
    "found": """
SELECT l.external_fact_key, l.product_key, p.product_name, p.category, p.brand, platform_name, l.currency, l.price, l.rating,
  l.review_count, l.product_url, l.collected_at, d.full_date
FROM latest l JOIN products p ON p.product_key = l.product_key JOIN platforms USING (platform_key) JOIN dates d USING (date_key)
WHERE (p.product_name ILIKE '%ring%' OR coalesce(p.brand, '') ILIKE '%ring%' OR coalesce(p.category, '') ILIKE '%ring%')
  AND platform_name IN ('ebay', 'etsy', 'advice_th') AND l.price >= 500 AND l.price <= 90000""",
    # Comparison requests
    "requests": """
SELECT DISTINCT l_orderkey AS request_id, external_fact_key FROM lines
JOIN platforms ON platform_name = source
JOIN products ON source_system = source AND source_product_id = CAST(l_partkey AS VARCHAR)
JOIN facts ON facts.product_key = products.product_key AND facts.platform_key = platforms.platform_key
  AND facts.date_key = CAST(strftime(l_shipdate, '%Y%m%d') AS INT)""",
    "request_items": """
SELECT request_id, external_fact_key, f.product_key, product_name, platform_name, f.currency, f.price, f.rating,
  f.review_count, f.product_url, f.collected_at
FROM requests JOIN facts f USING (external_fact_key) JOIN products p ON p.product_key = f.product_key
JOIN platforms USING (platform_key)""",
    "rates": """
SELECT base, CAST(rate AS DECIMAL(18,6)) AS rate FROM (VALUES ('USD', '33.579000'), ('JPY', '0.221500'),
  ('GBP', '44.107000'), ('THB', '1')) t(base, rate)""",
    "listings": """
SELECT l_orderkey AS page, l_linenumber AS position, CAST(l_partkey AS VARCHAR) AS listing_id,
  CASE WHEN p_size = 1 THEN ' ' ELSE p_name END AS title, 'https://shop.example/listing/' || l_partkey AS url,
  CASE WHEN p_size NOT IN (2, 3) THEN CAST(cents AS DOUBLE) / 100 END AS price, seen_at - to_hours(7) AS collected_at,
  l_shipdate AS updated_at, source FROM lines""",
    "metadata": """
SELECT CASE WHEN p_size = 1 THEN NULL ELSE ' B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS parent_asin,
  p_name || ' ' AS title, p_brand AS main_category,
  CASE WHEN p_size % 3 = 0 THEN [p_type, p_name] WHEN p_size % 3 = 1 THEN CAST([] AS VARCHAR[]) END AS categories,
  CASE WHEN p_size % 4 = 0 THEN '$' || p_size WHEN p_size % 4 = 1 THEN NULL ELSE ' ' || p_size || '.5' END AS price,
  CAST(p_size % 13 AS DOUBLE) / 2 AS average_rating, CAST(p_size - 3 AS BIGINT) AS rating_number, p_brand AS store FROM part""",
    "historical": """
SELECT 'amazon_2023' AS platform, trim(parent_asin) AS external_product_id, trim(title) AS product_name,
  coalesce(categories[1], main_category) AS category, CAST(NULL AS VARCHAR) AS brand, 'USD' AS currency,
  CASE WHEN regexp_full_match(trim(price), '\\d+(\\.\\d+)?') THEN TRY_CAST(trim(price) AS DOUBLE) END AS price,
  CAST(NULL AS DOUBLE) AS original_price, CAST(NULL AS DOUBLE) AS discount_percent,
  CASE WHEN average_rating BETWEEN 0 AND 5 THEN average_rating END AS rating,
  CASE WHEN rating_number >= 0 THEN rating_number END AS review_count, CAST(NULL AS BIGINT) AS sold_count,
  store AS seller_name, 'https://www.amazon.com/dp/' || trim(parent_asin) AS product_url, CAST(NULL AS VARCHAR) AS image_url,
  CAST(NULL AS TIMESTAMP) AS collected_at, CAST(NULL AS TIMESTAMP) AS source_updated_at,
  CAST(NULL AS TIMESTAMP) AS ingestion_timestamp, 'amazon_reviews_2023_historical_metadata' AS raw_source,
  DATE '2023-09-30' AS observation_date
FROM metadata WHERE length(trim(parent_asin)) > 0 AND length(trim(title)) > 0""",
    "price_list": """
SELECT 'list-' || (p_partkey // 500) AS snapshot, CASE WHEN p_size = 1 THEN 'other' ELSE 'advice_th' END AS source_system,
  CASE WHEN p_size = 2 THEN 'X1' WHEN p_size = 3 THEN 'A777' ELSE 'A' || p_partkey END AS external_product_id,
  CASE WHEN p_size = 4 THEN '  ' ELSE p_name END AS product_name, CASE WHEN p_size = 5 THEN NULL ELSE p_type END AS category,
  CASE WHEN p_size = 6 THEN CAST(-1 AS DOUBLE) WHEN p_size = 7 THEN CAST(1.125 AS DOUBLE)
    WHEN p_size = 8 THEN CAST(2e10 AS DOUBLE) ELSE round(p_retailprice, 2) END AS price,
  CASE WHEN p_size = 9 THEN 'USD' ELSE 'THB' END AS currency, '/productdetail/A' || p_partkey AS product_url,
  CASE WHEN p_size = 10 THEN 'http://elsewhere.example/' ELSE 'https://www.advice.co.th/list' END AS source_page,
  CASE WHEN p_size = 11 THEN 'soon' WHEN p_partkey = 700 THEN '2026-10-12T01:00:00+00:00'
    ELSE '2026-10-12T00:00:00+00:00' END AS observed_at_utc,
  CASE WHEN p_size = 12 THEN '' ELSE '2026-07-22 10:30' END AS price_list_last_update FROM part""",
    "good_prices": """
SELECT * FROM price_list WHERE source_system = 'advice_th' AND regexp_full_match(external_product_id, 'A[0-9]+')
  AND trim(product_name) <> '' AND price > 0 AND currency = 'THB' AND observed_at_utc IS NOT NULL""",
    # Pages
    "snippets": f"""
SELECT p_partkey, p_partkey // 20 AS page_id, CASE (p_partkey // 20) % 3
  WHEN 0 THEN CASE p_size % 7
    WHEN 0 THEN '<tr><td>' || p_name || '</td><td><a href="' || {_LINK} || '">Detail</a></td><td>' || {_amount('p_retailprice')} || ' ' || {_amount('p_retailprice')} || '</td></tr>'
    WHEN 1 THEN '<tr><td><a href="' || {_LINK} || '">' || p_name || '</a> ' || {_amount('p_retailprice')} || '</td></tr>'
    WHEN 2 THEN '<tr><td>' || p_name || '</td><td>' || {_amount('p_retailprice')} || '</td></tr>'
    ELSE '<tr><td>' || p_name || '</td><td><a href="' || {_LINK} || '">Detail</a></td><td>' || {_amount('p_retailprice')} || '</td></tr>' END
  WHEN 1 THEN CASE p_size % 7
    WHEN 0 THEN '<div class="card"><a href="' || {_LINK} || '">' || p_name || '</a><span>sold out</span></div>'
    WHEN 1 THEN '<div class="card"><a href="' || {_LINK} || '" title="' || p_name || ' boxed"><img src="x.png"></a><span>complete desktop set</span><span>' || {_amount('p_retailprice')} || '</span></div>'
    ELSE '<div class="card"><a href="' || {_LINK} || '" aria-label="' || p_name || '">Product</a><span>complete desktop set</span><span>' || {_amount('p_retailprice')} || '</span></div>' END
  ELSE '<p><a href="https://www.priceza.com/r/redirect?id=' || p_partkey || '">' || p_name || '</a> ' || {_amount('p_retailprice')} || '</p>' END AS snippet
FROM part""",
    "price_pages": """
SELECT page_id, 'https://shop.example/list/' || page_id || '?sort=x' AS url,
  '<html><head><meta name="csrf" content="s3cr3t"><style>p{margin:0}</style><script type="application/ld+json">' ||
  CASE page_id % 3 WHEN 0 THEN '{"@type":"ItemList","name":"list ","itemListElement":[' || ids || ']}'
    WHEN 1 THEN '[{"@type":"Store","@graph":[{"@type":"Product"},{"@type":"Offer"}]},{"@type":"WebPage"}]'
    ELSE '{"@type": broken' END ||
  '</script></head><body><form><input type=''hidden'' value=''tok''></form>' ||
  CASE page_id % 3 WHEN 0 THEN '<table>' || body || '</table>' WHEN 1 THEN '<main>' || body || '</main>'
    ELSE '<div id="root">' || body || '</div>' END || '</body></html>' AS html
FROM (SELECT page_id, string_agg(snippet, '' ORDER BY p_partkey) AS body,
  string_agg('"A' || p_partkey || '"', ',' ORDER BY p_partkey) AS ids FROM snippets GROUP BY page_id)""",
    "all_pages": """
SELECT -page_id - 1 AS page_id, url, html FROM price_pages UNION ALL SELECT page_id, url, html FROM pages""",
    # Keywords
    "words": """
SELECT p_name || ' ' || p_type AS keyword, min(p_partkey) AS first_seen FROM part GROUP BY 1""",
    "page_events": """
SELECT event_id, p_name || ' ' || p_type AS keyword, CAST(json_extract_string(props, '$.k') AS INT) AS page, ts AS fetched_at,
  event_type, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'partial' END AS state
FROM events JOIN part ON p_partkey = user_id""",
    "kw_state": """
SELECT DISTINCT ON (keyword) keyword, state, page AS last_page, fetched_at AS completed_at FROM page_events
ORDER BY keyword, fetched_at DESC, event_id DESC""",
}

_NAME = re.compile(r"[a-z_]+")


def _needs(sql: str) -> list[str]:
    mentioned = set(_NAME.findall(re.sub(r"'[^']*'", "''", sql)))
    return [name for name in PARTS if name in mentioned]


def _with(body: str) -> str:
    """``body`` behind the named subqueries it needs, in dependency order."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _needs(sql):
            if name not in order:
                visit(PARTS[name])
                order.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} AS ({PARTS[name]})" for name in order)
    return f"WITH {ctes}\n{body}" if ctes else body


def _std(*columns: str, table: str = "std") -> str:
    return f"SELECT {', '.join(columns)} FROM {table}"


_BAND = (
    "CASE WHEN {p} IS NULL THEN 'Missing price' WHEN {p} < 25 THEN '< 25' WHEN {p} < 50 THEN '25-49.99' "
    "WHEN {p} < 100 THEN '50-99.99' WHEN {p} < 250 THEN '100-249.99' WHEN {p} < 500 THEN '250-499.99' ELSE '500+' END"
)
_DATE_ATTRIBUTES = """CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date, CAST(day(full_date) AS INT) AS day,
  CAST(month(full_date) AS INT) AS month, monthname(full_date) AS month_name, CAST(quarter(full_date) AS INT) AS quarter,
  CAST(year(full_date) AS INT) AS year, CAST({dow}(full_date) AS INT) AS day_of_week, dayname(full_date) AS day_name,
  isodow(full_date) IN (6, 7) AS is_weekend"""
_SCORED = """
SELECT request_id, external_fact_key, round(coalesce((hi - p) / (CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE hi - lo END) * {wp}::DOUBLE, 0)
  + coalesce(CAST(rating AS DOUBLE) / 5 * {wr}::DOUBLE, 0)
  + CASE WHEN review_count IS NULL THEN 0 ELSE least(CAST(review_count AS DOUBLE) / 1000, 1.0::DOUBLE) * 0.15::DOUBLE END, 3)
  AS score, p, rating, review_count
FROM (SELECT *, min(p) OVER w AS lo, max(p) OVER w AS hi FROM ({items})
  WINDOW w AS (PARTITION BY request_id))"""
_PRICED = """SELECT i.request_id, i.external_fact_key, i.rating, i.review_count, {price} AS p
  FROM request_items i JOIN (SELECT request_id FROM request_items GROUP BY request_id
    HAVING count(*) FILTER (price IS NULL OR currency IS NULL) = 0 {more}) g USING (request_id)
  LEFT JOIN rates ON base = currency"""
_CATALOG = "FROM products WHERE source_system = 'amazon_2023'"
_CELLS = "platform, external_product_id, product_name, currency, price, observation_date"
_LOADED = """SELECT platform AS marketplace, observation_date, external_product_id AS source_product_id, {name} AS product_name,
  currency, CAST({price} AS DECIMAL(18,4)) AS price, CAST({rating} AS DECIMAL(5,2)) AS rating
  FROM daily d JOIN (SELECT platform, external_product_id, arg_max(product_name, (collected_at, product_name)) AS newest,
    min(observation_date) AS first_day FROM daily GROUP BY ALL) USING (platform, external_product_id)"""
_OLD = "CASE WHEN observation_date < DATE '2001-01-01' THEN 1 ELSE {} END"
_MARKET = "FROM products WHERE source_system <> 'internal'"
_BLANK = "count(*) FILTER ({c} IS NULL OR trim({c}) = '')"
_CANONICAL_DAILY = "platform, external_product_id, observation_date"
_HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<svg\b[^>]*>.*?</svg\s*>"
    r"|<noscript\b[^>]*>.*?</noscript\s*>"
)


def _decoded(text: str) -> str:
    for entity, character in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"),
                              ("&amp;", "&")]:
        text = f"replace({text}, '{entity}', '{character}')"
    return text


def _tie_pick(table: str, keys: str, skip: set[str], columns: list[str] = RAW, out: str = "*") -> str:
    return (
        f"SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY collected_at DESC NULLS LAST, "
        f"{_ties(skip | {'collected_at'}, columns)}) AS rn FROM {table}) WHERE rn = 1"
    )


_HYBRID = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_product_id
        ORDER BY collected_at DESC, product_name, category, brand, currency, price NULLS LAST, rating NULLS LAST,
        review_count) AS rn FROM (
      SELECT 'amazon_csv' AS platform, CASE WHEN p_size <> 1 THEN CAST(p_partkey // 2 AS VARCHAR) END AS external_product_id,
        p_name AS product_name, p_type AS category, p_brand AS brand, 'USD' AS currency,
        CASE WHEN p_size NOT IN (2, 3) THEN CAST(p_size AS DOUBLE) END AS price,
        CASE WHEN p_size / 5.0 <= 5 THEN CAST(p_size AS DOUBLE) / 5 END AS rating, CAST(p_size * 7 AS BIGINT) AS review_count,
        CAST(NULL AS VARCHAR) AS seller_name,
        make_timestamp(2023, 1 + p_size % 9, 10 + p_partkey % 10, 10, 0, 0.125) AS collected_at,
        'historical_csv' AS raw_source, make_date(2023, 1 + p_size % 9, 10 + p_partkey % 10) AS observation_date FROM part)
      WHERE external_product_id IS NOT NULL) WHERE rn = 1"""
BODIES: dict[str, str] = {
    # sources and sinks
    "read_optional_source": """SELECT platform, external_product_id, product_name, price, collected_at, product_url
      FROM std WHERE product_url NOT LIKE '%/etsy/%'""",
    "read_heterogeneous_snapshots": """SELECT raw_source, count(*) AS rows, count(price) AS priced,
      CASE WHEN raw_source = 'batch_A' THEN 0 ELSE count(seller_name) END AS sellers FROM std GROUP BY 1""",
    "read_latest_snapshot_sample": """SELECT * FROM price_list WHERE CAST(split_part(snapshot, '-', 2) AS BIGINT) =
      (SELECT max(p_partkey // 500) FROM part) ORDER BY ALL LIMIT 100""",
    "read_gz_jsonl_typed": """SELECT main_category, count(*) AS rows, count(parent_asin) AS ids, count(price) AS prices,
      CAST(sum(rating_number) AS BIGINT) AS ratings FROM metadata GROUP BY 1""",
    "read_multiline_json_products": """SELECT snapshot AS dataset, external_product_id, product_name, category, price, currency
      FROM price_list""",
    "read_json_inferred": "SELECT * FROM silver",
    "read_csv_strict": "SELECT product_name, brand FROM titles",
    "read_partition_with_base": "SELECT platform, brand, count(*) AS rows FROM daily WHERE platform = 'etsy' GROUP BY ALL",
    "read_parquet_glob": "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem",
    "read_warehouse_table": "SELECT product_key, source_system, source_product_id FROM products",
    "list_unprepared_snapshots": """SELECT '/in/page_' || page_id || '.json' AS path FROM pages
      WHERE page_id NOT IN (SELECT doc_id FROM labels)""",
    "write_partitioned_products": "SELECT platform, observation_date, count(*) AS rows FROM daily GROUP BY ALL",
    "write_once": "SELECT snapshot, external_product_id, product_name, price FROM price_list",
    "write_json_presentation": "SELECT platform AS source_system, currency, count(*) AS total_rows FROM daily GROUP BY ALL",
    "write_quoted_csv": """SELECT 'amazon_2023' AS source_system, source_product_id, product_name,
      nullif(category, '') AS category, nullif(brand, '') AS brand FROM best_titles""",
    "append_warehouse_rows": """SELECT row_number() OVER (ORDER BY substr(md5('internal|' || p_partkey), 1, 3),
      CAST(p_partkey AS VARCHAR)) AS product_key, CAST(p_partkey AS VARCHAR) AS source_product_id FROM part""",
    "stage_records": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_product_id, full_date
      ORDER BY collected_at DESC, product_name, currency NULLS LAST, price NULLS LAST, product_url) AS rn FROM (
        SELECT trim(external_product_id) AS external_product_id,
          coalesce(nullif(trim(product_name), ''), 'Etsy product ' || trim(external_product_id)) AS product_name, currency,
          round(TRY_CAST(price AS DOUBLE), 4) AS price, product_url, TRY_CAST(collected_at AS TIMESTAMP) AS collected_at,
          CAST(TRY_CAST(collected_at AS TIMESTAMP) AS DATE) AS full_date FROM raw)
      WHERE external_product_id <> '' AND collected_at IS NOT NULL) WHERE rn = 1""",
    "export_dim_csv": """SELECT source_system, external_product_id AS source_product_id, product_name,
      coalesce(category, '') AS category FROM (SELECT *, row_number() OVER (PARTITION BY source_system, external_product_id
        ORDER BY price DESC, snapshot, product_name, category NULLS LAST, currency, product_url, source_page) AS rn
        FROM good_prices) WHERE rn = 1""",
    "export_price_snapshot_csv": """SELECT external_product_id AS source_product_id,
      CAST(TRY_CAST(price AS DECIMAL(12,2)) AS VARCHAR) AS price_thb, observed_at_utc, price_list_last_update, source_page
      FROM (SELECT *, min(observed_at_utc) OVER s = max(observed_at_utc) OVER s AS one_time FROM (
          SELECT *, count(*) OVER (PARTITION BY snapshot, external_product_id) AS n FROM price_list)
        WHERE n = 1 AND source_system = 'advice_th' AND regexp_full_match(external_product_id, 'A[0-9]+')
          AND trim(product_name) <> '' AND currency = 'THB' AND price > 0 AND price = round(price, 2)
          AND price <= 9999999999.99 AND observed_at_utc <> 'soon' AND price_list_last_update <> ''
          AND starts_with(source_page, 'https://www.advice.co.th/')
        WINDOW s AS (PARTITION BY snapshot)) WHERE one_time""",
    # cleaning
    "standardize": "SELECT * FROM std",
    "add_missing_columns": f"""SELECT {', '.join(
        {'external_product_id': 'external_product_id'}.get(c) or f'CAST(NULL AS {t}) AS {c}' for c, t in
        zip(RAW, ['VARCHAR'] * 6 + ['DOUBLE'] * 4 + ['BIGINT'] * 2 + ['VARCHAR'] * 3 + ['TIMESTAMP'] * 3 + ['VARCHAR']))} FROM raw""",
    "clean_strings": _std("external_product_id", "product_name", "category", "brand", "currency", "seller_name",
                          "product_url", "image_url", "raw_source"),
    "normalize_platform": """SELECT source, coalesce(nullif(lower(trim(platform)), ''), source) AS platform,
      external_product_id FROM raw""",
    "cast_measures": """SELECT product_url, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(original_price AS DOUBLE)
      AS original_price, discount_percent, rating, review_count, sold_count FROM raw""",
    "parse_timestamps": _std("product_url", "collected_at", "source_updated_at", "ingestion_timestamp"),
    "observation_date": "SELECT observation_date, count(*) AS rows FROM std GROUP BY 1",
    "null_negative": _std("product_url", "price", "original_price", "review_count", "sold_count"),
    "null_rating_out_of_range": "SELECT rating, count(*) AS rows FROM std GROUP BY 1",
    "stamp_processed_at": f"SELECT {_CANONICAL_DAILY}, TIMESTAMP '2026-01-01' AS processed_at FROM daily",
    "resolve_alias_columns": """SELECT external_product_id AS product_id, product_name, price AS price_text, currency FROM raw""",
    "silver_projection": "SELECT * FROM silver",
    "row_to_json": "SELECT p_partkey, CAST(to_json(part) AS VARCHAR) AS source_record_json FROM part",
    "null_tokens": """SELECT event_id, CASE WHEN event_type = 'purchase' THEN event_type END AS value FROM events""",
    "parse_price_text": """SELECT parent_asin, CASE WHEN regexp_full_match(trim(price), '\\d+(\\.\\d+)?')
      THEN CAST(trim(price) AS DOUBLE) END AS price FROM metadata""",
    "parse_currency_price": """SELECT p_partkey, CASE WHEN p_size % 5 NOT IN (0, 1) THEN round(p_retailprice, 2) END AS price
      FROM part""",
    "money_struct_to_price": "SELECT page, position, listing_id, price FROM listings",
    "epoch_to_timestamp": """SELECT p_partkey, CASE WHEN p_size <> 1
      THEN make_timestamp((1600000000 + p_partkey * 3600) * 1000000) END AS at FROM part""",
    "to_utc_naive": "SELECT page, position, listing_id, collected_at FROM listings",
    "parse_timestamp_pattern": "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) END AS at FROM events",
    "fallback_product_name": """SELECT product_url, coalesce(nullif(trim(product_name), ''),
      'Etsy product ' || trim(external_product_id)) AS product_name FROM raw""",
    "bound_price": "SELECT p_partkey, CASE WHEN p_size NOT IN (1, 2) THEN CAST(p_partkey AS DOUBLE) + 0.25 END AS price FROM part",
    "category_from_array": "SELECT parent_asin, title, coalesce(categories[1], main_category) AS category FROM metadata",
    "category_or_json": """SELECT parent_asin, title, coalesce(CASE WHEN rating_number % 2 = 0 THEN main_category END,
      CASE WHEN len(categories) = 0 THEN '[]' WHEN len(categories) > 0
        THEN '["' || array_to_string(categories, '","') || '"]' END) AS category FROM metadata""",
    "product_url_from_id": """SELECT product_name, 'https://www.amazon.com/dp/' || source_product_id AS product_url FROM titles""",
    "strip_nul": "SELECT p_partkey, p_name || p_type AS product_name FROM part",
    "blank_to_null": """SELECT product_url, nullif(category, '') AS category,
      coalesce(nullif(trim(category), ''), 'Uncategorized') AS category_label FROM raw""",
    "price_band": f"SELECT {_BAND.format(p='(price / 100)')} AS price_band, count(*) AS rows FROM daily GROUP BY 1",
    "date_key": """SELECT CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key,
      count(*) AS rows FROM orders GROUP BY ALL""",
    "date_attributes": f"""SELECT {_DATE_ATTRIBUTES.format(dow='isodow')}, CAST(dayofweek(full_date) AS INT)
      AS day_of_week_sunday0 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders)""",
    "fact_measure_projection": """SELECT CAST(strftime(observation_date, '%Y%m%d') AS INT) AS date_key,
      CAST(external_product_id AS BIGINT) AS product_key, CAST(length(platform) AS INT) AS platform_key, currency,
      CAST(price AS DECIMAL(18,4)) AS price, CAST(original_price AS DECIMAL(18,4)) AS original_price,
      CAST(discount_percent AS DECIMAL(10,4)) AS discount_percent, CAST(rating AS DECIMAL(5,2)) AS rating, review_count,
      sold_count, seller_name, product_url, collected_at FROM daily""",
    "line_and_order_totals": """SELECT order_id, order_number, customer_id, order_date, payment_method, sales_channel,
      order_status, CAST(coalesce((SELECT sum(line_total) FROM items i WHERE i.order_id = o.order_id), 0) AS DECIMAL(14,2))
      AS total_amount FROM shop_orders o""",
    # gates
    "filter_valid_core": f"SELECT {_CELLS} FROM valid",
    "filter_loadable": f"SELECT {_CELLS} FROM std WHERE observation_date IS NOT NULL",
    "filter_valid_price_list": "SELECT external_product_id, product_name, price FROM good_prices",
    "validate_price_snapshot": """SELECT snapshot, external_product_id, reason FROM (
      SELECT snapshot, external_product_id, unnest([CASE WHEN source_system <> 'advice_th' THEN 'wrong_source' END,
        CASE WHEN NOT regexp_full_match(external_product_id, 'A[0-9]+') THEN 'invalid_id' END,
        CASE WHEN trim(product_name) = '' THEN 'blank_name' END, CASE WHEN currency <> 'THB' THEN 'wrong_currency' END,
        CASE WHEN price <= 0 THEN 'nonpositive_price' END,
        CASE WHEN price <> round(price, 2) THEN 'too_many_decimals' END,
        CASE WHEN price > 9999999999.99 THEN 'price_too_large' END,
        CASE WHEN observed_at_utc = 'soon' THEN 'bad_observed_at' END,
        CASE WHEN price_list_last_update = '' THEN 'bad_list_update' END,
        CASE WHEN NOT starts_with(source_page, 'https://www.advice.co.th/') THEN 'wrong_page' END]) AS reason FROM price_list)
      WHERE reason IS NOT NULL
      UNION ALL SELECT snapshot, external_product_id, 'duplicate_id' FROM price_list GROUP BY 1, 2 HAVING count(*) > 1
      UNION ALL SELECT snapshot, NULL, 'mixed_observation_times' FROM price_list GROUP BY 1
        HAVING count(DISTINCT observed_at_utc) > 1""",
    "filter_catalog_dim": """SELECT * FROM titles WHERE length(source_product_id) BETWEEN 1 AND 255
      AND length(product_name) > 0""",
    "reject_unexpected_platform": "SELECT platform, count(*) AS rows FROM std WHERE platform <> 'etsy' GROUP BY 1",
    "gate_row_count": "SELECT count(*) AS rows FROM daily",
    "check_required_columns": "SELECT count(*) AS rows, 'image_url,observation_date' AS missing_columns FROM lines",
    "product_search_filter": """SELECT marketplace AS platform_name, source_product_id, product_name, brand, category, price,
      collected_at FROM snapshot WHERE (product_name ILIKE '%ring%' OR brand ILIKE '%ring%' OR category ILIKE '%ring%')
      AND marketplace IN ('ebay', 'etsy', 'advice_th') AND price BETWEEN 500 AND 90000""",
    "catalog_search_filter": f"""SELECT product_key, source_product_id, product_name, category, brand {_CATALOG}
      AND (product_name ILIKE '%bolt%' OR source_product_id ILIKE '%bolt%') AND category = 'SMALL'""",
    "exclude_internal": f"SELECT product_key, source_system, source_product_id {_MARKET}",
    "check_constraints_internal": """SELECT 'products' AS table_name, p_partkey AS row_id, 'negative_stock' AS reason
        FROM part WHERE p_size - 5 < 0
      UNION ALL SELECT 'customers', source_customer_id, 'age_out_of_range' FROM customers_src WHERE NOT age BETWEEN 10 AND 120
      UNION ALL SELECT 'products', p_partkey, 'negative_price' FROM part WHERE p_retailprice < 0
      UNION ALL SELECT 'orders', order_id, 'negative_total' FROM shop_orders WHERE total_amount < 0
      UNION ALL SELECT 'orders', order_id, 'missing_customer_id' FROM shop_orders
        WHERE customer_id NOT IN (SELECT source_customer_id FROM customers_src)
      UNION ALL SELECT 'order_items', order_item_id, 'quantity_not_positive' FROM items WHERE quantity <= 0
      UNION ALL SELECT 'order_items', order_item_id, 'negative_total' FROM items WHERE line_total < 0
      UNION ALL SELECT 'order_items', order_item_id, 'missing_order_id' FROM items
        WHERE order_id NOT IN (SELECT o_orderkey FROM orders)""",
    # joins
    "new_platforms": """SELECT DISTINCT platform AS platform_name, 'marketplace' AS platform_type FROM valid
      WHERE platform NOT IN (SELECT CASE WHEN p_size > 25 THEN 'ebay' ELSE 'etsy' END FROM part)""",
    "new_products": """SELECT source_system, source_product_id, product_name, category, brand, sku, collected_at FROM (
      SELECT platform AS source_system, external_product_id AS source_product_id, product_name, category, brand,
        CAST(NULL AS VARCHAR) AS sku, collected_at, row_number() OVER (PARTITION BY platform, external_product_id
          ORDER BY collected_at DESC, product_name, category, brand) AS rn FROM valid v
      WHERE NOT EXISTS (SELECT 1 FROM valid o WHERE o.platform = v.platform AND
        o.external_product_id = v.external_product_id AND o.observation_date < DATE '2001-01-01')) WHERE rn = 1""",
    "new_facts": """SELECT CAST(strftime(observation_date, '%Y%m%d') AS INT) AS date_key,
      CAST(external_product_id AS BIGINT) AS product_key, CAST(length(platform) AS INT) AS platform_key, price
      FROM daily WHERE observation_date >= DATE '2001-01-01'""",
    "resolve_fact_keys": """SELECT platform, external_product_id, observation_date,
      CAST(strftime(observation_date, '%Y%m%d') AS INT) AS date_key, product_key, platform_key
      FROM daily JOIN platforms ON platform_name = platform
      LEFT JOIN products ON source_system = platform AND source_product_id = external_product_id""",
    "unresolved_facts": """SELECT platform, observation_date, count(*) AS rows FROM daily
      WHERE observation_date >= DATE '2001-01-01' GROUP BY ALL""",
    "sales_line_join": "SELECT * FROM sales_lines",
    "sales_key_lookup": """SELECT order_id, order_item_id, date_key, product_key, customer_key, platform_key, line_total
      FROM sales_keyed""",
    "missing_dates_check": "SELECT count(*) AS missing FROM daily WHERE observation_date NOT IN (SELECT full_date FROM dates)",
    "marketplace_snapshot": "SELECT * FROM snapshot",
    "platform_left_quality_join": """SELECT platform_name, count(external_fact_key) AS fact_rows,
      count(source_product_id) AS product_rows, count(full_date) AS day_rows, max(full_date) AS newest_day FROM platforms
      LEFT JOIN facts USING (platform_key) LEFT JOIN products USING (product_key) LEFT JOIN dates USING (date_key)
      GROUP BY 1""",
    "compare_products": "SELECT * FROM request_items",
    "product_history": """SELECT p.product_key, source_product_id, product_name, category, brand, platform_name, currency, price,
      rating, review_count, product_url, collected_at, external_fact_key
      FROM products p LEFT JOIN facts f ON f.product_key = p.product_key LEFT JOIN platforms USING (platform_key)""",
    "convert_currency": """SELECT currency, external_fact_key, price, rate AS fx_rate,
      CAST(price * rate AS DECIMAL(24,6)) AS price_converted, 'THB' AS target_currency
      FROM facts LEFT JOIN rates ON base = currency""",
    "keyword_reconcile": """SELECT keyword, CASE WHEN state IN ('completed', 'partial') THEN state ELSE 'pending' END AS status,
      CASE WHEN state IN ('completed', 'partial') THEN last_page ELSE 0 END AS last_page,
      CASE WHEN state IN ('completed', 'partial') THEN completed_at END AS last_run_at
      FROM words LEFT JOIN kw_state USING (keyword)""",
    # One round after the other, each over the whole list so far.
    "keyword_cross_refine": """SELECT * FROM (WITH RECURSIVE refined AS (
        SELECT keyword, 0 AS refinement, 0 AS n FROM words
        UNION ALL SELECT keyword || tail, refinement + bit, n + 1 FROM refined, (SELECT unnest(
          ['人気', 'ランキング', '送料無料', '新品', '日本製', '大容量', 'コンパクト', '業務用', 'セット', '限定']) AS q, unnest(range(10)) AS k), LATERAL (
          SELECT ' ' || q AS tail, CAST(1 << k AS INT) AS bit UNION ALL SELECT '', 0) WHERE k = n)
      SELECT keyword, min(refinement) AS refinement FROM refined WHERE n = 10 GROUP BY keyword)""",
    "fk_orphans": """SELECT 'product_key' AS foreign_key, count(*) AS orphans FROM facts
        WHERE product_key NOT IN (SELECT product_key FROM products WHERE category <> 'PROMO')
      UNION ALL SELECT 'platform_key', count(*) FROM facts WHERE platform_key NOT IN (SELECT platform_key FROM platforms)
      UNION ALL SELECT 'date_key', count(*) FROM facts WHERE date_key >= 20010101""",
    # aggregations
    "gold_marketplace_summary": """SELECT platform AS source_system, currency, count(*) AS total_rows,
      count(DISTINCT external_product_id) AS unique_products, count(price) AS products_with_price,
      count(*) - count(price) AS products_missing_price, round(avg(price), 2) AS average_price FROM daily GROUP BY ALL""",
    "platform_counts": "SELECT platform, count(*) AS rows FROM daily GROUP BY 1",
    "platform_day_counts": "SELECT platform, observation_date, count(*) AS rows FROM daily GROUP BY ALL",
    "etl_quality_summary": """SELECT (SELECT count(*) FROM valid) AS rows_before, count(*) AS rows_after,
      (SELECT count(*) FROM valid) - count(*) AS duplicates_removed, count(price) AS rows_with_price,
      count(*) - count(price) AS rows_missing_price, count(DISTINCT observation_date) AS snapshot_days FROM daily""",
    "silver_quality": """SELECT source_system, count(*) AS total_rows, count(product_id) AS valid_ids,
      count(product_name) AS valid_names, count(price) AS valid_prices FROM silver GROUP BY 1""",
    "products_by_source_with_total": f"""SELECT source_system, count(*) AS unique_products {_MARKET} GROUP BY 1
      UNION ALL SELECT 'TOTAL_MARKETPLACE', count(*) {_MARKET}""",
    "products_by_load_day": f"""SELECT CAST(created_at AS DATE) AS warehouse_load_date, source_system,
      count(*) AS new_unique_products {_MARKET} GROUP BY ALL""",
    "product_growth": f"""SELECT CAST(created_at AS DATE) AS ingestion_date, source_system AS marketplace,
      count(*) AS new_unique_products {_MARKET} GROUP BY ALL""",
    "duplicate_products": f"""SELECT source_system, source_product_id, count(*) AS duplicate_count {_MARKET}
      GROUP BY ALL HAVING count(*) > 1""",
    "missing_identity_counts": f"""SELECT source_system, {_BLANK.format(c='source_product_id')} AS missing_product_id,
      {_BLANK.format(c='product_name')} AS missing_product_name {_MARKET} GROUP BY 1""",
    "facts_by_source_day": """SELECT platform_name AS source_system, full_date AS observation_date, count(*) AS warehouse_rows
      FROM facts JOIN platforms USING (platform_key) JOIN dates USING (date_key) WHERE platform_type <> 'internal' GROUP BY ALL""",
    "target_progress": f"""SELECT count(*) AS unique_marketplace_products, 500000 - count(*) AS remaining_to_500k,
      1000000 - count(*) AS remaining_to_1m {_MARKET}""",
    "platform_quality": """SELECT *, CASE WHEN orphan_foreign_keys > 0 OR null_date_keys > 0 OR invalid_prices > 0 THEN 'FAIL'
        WHEN fact_rows = 0 OR null_prices > 0 OR missing_currency > 0 THEN 'WARNING' ELSE 'PASS' END AS status FROM (
      SELECT platform_name, count(external_fact_key) AS fact_rows, count(DISTINCT f.product_key) AS unique_products,
        count(*) FILTER (external_fact_key IS NOT NULL AND f.date_key IS NULL) AS null_date_keys,
        count(*) FILTER (external_fact_key IS NOT NULL AND price IS NULL) AS null_prices,
        count(*) FILTER (external_fact_key IS NOT NULL AND price < 0) AS invalid_prices,
        count(*) FILTER (external_fact_key IS NOT NULL AND nullif(trim(currency), '') IS NULL) AS missing_currency,
        count(*) FILTER (external_fact_key IS NOT NULL AND (p.product_key IS NULL OR d.date_key IS NULL)) AS orphan_foreign_keys,
        min(full_date) AS min_observation_date, max(full_date) AS max_observation_date
      FROM platforms LEFT JOIN facts f USING (platform_key) LEFT JOIN products p ON p.product_key = f.product_key
      LEFT JOIN dates d ON d.date_key = f.date_key WHERE platform_type <> 'internal' GROUP BY 1)""",
    "duplicate_facts": """SELECT date_key, product_key, platform_key, count(*) AS duplicate_count FROM facts GROUP BY ALL
      HAVING count(*) > 1""",
    "products_by_marketplace": f"""SELECT source_system AS marketplace, count(*) AS unique_products,
      min(created_at) AS first_loaded_at, max(created_at) AS latest_loaded_at {_MARKET} GROUP BY 1""",
    "products_by_category": f"""SELECT source_system AS marketplace, coalesce(nullif(trim(category), ''), 'Uncategorized')
      AS category, count(*) AS unique_products {_MARKET} GROUP BY ALL""",
    "price_distribution": f"""SELECT platform_name AS marketplace, currency, {_BAND.format(p='price')} AS price_band,
      count(*) AS observations FROM facts JOIN platforms USING (platform_key) WHERE platform_type <> 'internal' GROUP BY ALL""",
    "catalog_data_quality": f"""SELECT source_system AS marketplace, count(*) AS total_products,
      {_BLANK.format(c='source_product_id')} AS missing_product_id, {_BLANK.format(c='product_name')} AS missing_product_name,
      count(*) - count(DISTINCT source_product_id) AS duplicate_product_ids {_MARKET} GROUP BY 1""",
    "warehouse_summary": """SELECT count(*) AS snapshot_records, count(DISTINCT product_key) AS searchable_products,
      count(DISTINCT platform_key) AS priced_platforms, max(collected_at) AS latest_collected_at FROM facts""",
    "table_row_counts": """SELECT 'dim_date' AS table_name, count(*) AS rows FROM dates
      UNION ALL SELECT 'dim_platform', count(*) FROM platforms UNION ALL SELECT 'dim_product', count(*) FROM products
      UNION ALL SELECT 'dim_customer', count(*) FROM customers UNION ALL SELECT 'fact_sales', count(*) FROM sales
      UNION ALL SELECT 'fact_external_product', count(*) FROM facts""",
    "before_after_load_counts": """SELECT *, rows_after - rows_before AS rows_added FROM (
      SELECT 'dim_product' AS table_name, count(*) AS rows_after,
        count(*) FILTER (source_system <> 'amazon_2023') AS rows_before FROM products
      UNION ALL SELECT 'fact_external_product', count(*), count(*) FILTER (date_key < 20010101) FROM facts)""",
    "catalog_profile": """SELECT 'metadata' AS dataset, count(*) AS rows, count(DISTINCT parent_asin) AS unique_product_ids,
        'parent_asin' AS id_column, 'title' AS product_name_column, 'price' AS price_column,
        CAST(NULL AS VARCHAR) AS observation_date_column, 'average_rating' AS rating_column,
        'rating_number' AS review_count_column, 'main_category' AS category_column, 'store' AS brand_column,
        FALSE AS has_price_observation FROM metadata
      UNION ALL SELECT 'listing', count(*), count(DISTINCT external_product_id) FILTER (trim(external_product_id) <> ''),
        'asin', 'product_title', 'priceUSD', NULL, NULL, NULL, NULL, 'brand', FALSE FROM raw""",
    "unique_catalog_products": """SELECT count(DISTINCT id) AS unique_products FROM (SELECT trim(parent_asin) AS id FROM metadata
      UNION ALL SELECT source_product_id FROM titles) WHERE trim(id) <> ''""",
    "avg_price_per_currency": """SELECT currency, count(*) AS snapshot_rows, count(DISTINCT (marketplace, source_product_id))
      AS products, count(*) FILTER (price IS NOT NULL AND trim(currency) <> '') AS priced_snapshot_rows,
      round(avg(CAST(price AS DOUBLE)), 4) AS average_price FROM snapshot GROUP BY 1""",
    "fact_totals_by_platform": """SELECT platform_name, count(*) AS snapshots, count(DISTINCT product_key) AS distinct_products,
      min(collected_at) AS first_collected_at, max(collected_at) AS last_collected_at,
      count(*) FILTER (currency IS NULL OR trim(currency) = '') AS blank_currency_rows
      FROM facts JOIN platforms USING (platform_key) GROUP BY 1""",
    "group_items_by_currency": """SELECT request_id, currency, CAST(count(*) AS INT) AS item_count,
      string_agg(CAST(external_fact_key AS VARCHAR), ',' ORDER BY external_fact_key) AS fact_keys FROM request_items
      WHERE price IS NOT NULL GROUP BY ALL""",
    "daily_request_metrics": """SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)
      AS http_attempts, count(*) FILTER (event_type = 'error') AS http_429,
      arg_max(CAST(json_extract_string(props, '$.k') AS BIGINT), ts) AS latest_http_attempts FROM events GROUP BY 1""",
    "keyword_progress": """SELECT count(*) FILTER (state = 'completed') AS completed_keywords,
      count(*) - count(*) FILTER (state = 'completed') AS pending_keywords FROM words LEFT JOIN kw_state USING (keyword)""",
    "conflicting_prices": """SELECT platform, external_product_id, observation_date, min(price) AS min_price,
      max(price) AS max_price, count(DISTINCT price) AS distinct_prices FROM std GROUP BY 1, 2, 3
      HAVING count(DISTINCT price) > 1""",
    # pick-one
    "dedupe_daily_snapshot": "SELECT * FROM daily",
    "dedupe_daily_keep_last": """SELECT * EXCLUDE (rn) FROM (SELECT external_product_id, observation_date AS full_date,
      platform, product_name, price, collected_at, product_url, row_number() OVER (
        PARTITION BY external_product_id, observation_date ORDER BY collected_at DESC, platform, product_name,
        price ASC NULLS LAST, product_url) AS rn FROM valid) WHERE rn = 1""",
    "dedupe_products": _tie_pick("valid", "platform, external_product_id", {"platform", "external_product_id"},
                                 [*RAW, "observation_date"], "* EXCLUDE (rn)"),
    "latest_name_per_product": """SELECT DISTINCT ON (external_product_id) external_product_id,
      product_name || ' ' || raw_source AS product_name FROM valid
      ORDER BY external_product_id, collected_at DESC, product_name || ' ' || raw_source DESC""",
    "best_title_per_product": "SELECT * FROM best_titles",
    "latest_fact_per_product": "SELECT * FROM latest",
    "dedupe_facts": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY date_key, product_key, platform_key
      ORDER BY collected_at DESC, currency NULLS LAST, price NULLS LAST, sold_count, seller_name) AS rn FROM (
        SELECT CAST(strftime(observation_date, '%Y%m%d') AS INT) AS date_key, CAST(external_product_id AS BIGINT) AS product_key,
          CAST(length(platform) AS INT) AS platform_key, currency, price, sold_count, seller_name, collected_at
        FROM valid)) WHERE rn = 1""",
    "first_seen_products": """SELECT DISTINCT ON (id) id AS external_product_id, collected_at AS first_seen_at,
      page AS first_page, position AS first_position FROM (SELECT *, source || '/' || listing_id AS id FROM listings)
      ORDER BY id, collected_at, page, position""",
    "score_min_max": "SELECT request_id, min(price) AS min_price, max(price) AS max_price FROM request_items GROUP BY 1",
    "assign_surrogate_keys": """SELECT 1000 + row_number() OVER (ORDER BY substr(md5(platform || '|' || external_product_id), 1, 3),
      platform, external_product_id) AS product_key, platform, external_product_id FROM (
      SELECT DISTINCT platform, external_product_id FROM valid)""",
    # search
    "product_search_page": "SELECT * FROM found ORDER BY price DESC NULLS LAST, external_fact_key LIMIT 20 OFFSET 20",
    "product_search_after": """SELECT *, (SELECT count(*) FROM found) AS total FROM found
      ORDER BY price DESC NULLS LAST, external_fact_key LIMIT 20 OFFSET 20""",
    "catalog_search_after": f"""SELECT product_key, source_product_id, product_name, category, brand, count(*) OVER () AS total {_CATALOG}
      AND (product_name ILIKE '%bolt%' OR source_product_id ILIKE '%bolt%') ORDER BY product_key LIMIT 10 OFFSET 10""",
    "product_search_by_postings": "SELECT * FROM found",
    "catalog_search_by_postings": f"""SELECT product_key, source_product_id, product_name, category, brand {_CATALOG}
      AND (product_name ILIKE '%bolt%' OR source_product_id ILIKE '%bolt%') AND category = 'SMALL'""",
    "product_search_total": "SELECT count(*) AS total FROM found",
    "catalog_search_page": f"""SELECT product_key, source_product_id, product_name, category, brand {_CATALOG}
      AND (product_name ILIKE '%bolt%' OR source_product_id ILIKE '%bolt%') ORDER BY product_key LIMIT 10 OFFSET 10""",
    "catalog_search_total": f"""SELECT count(*) AS total {_CATALOG}
      AND (product_name ILIKE '%bolt%' OR source_product_id ILIKE '%bolt%')""",
    "platform_list": "SELECT platform_name, platform_type FROM platforms WHERE platform_type <> 'internal'",
    "sample_limit": "SELECT external_product_id, product_name FROM historical ORDER BY 1 LIMIT 500",
    # set operations
    "union_marketplaces": """SELECT source, product_url, CASE WHEN source <> 'stockx' THEN price END AS price,
      CASE WHEN source <> 'stockx' THEN currency END AS currency, CASE WHEN source = 'stockx' THEN rating END AS rating,
      sold_count FROM raw""",
    "union_strict": f"""SELECT {_CELLS}, raw_source FROM daily UNION ALL
      SELECT {_CELLS}, raw_source FROM historical""",
    "missing_dates": """SELECT DISTINCT observation_date AS full_date FROM daily
      WHERE observation_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "distinct_order_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders",
    "union_with_total": """SELECT platform, count(*) AS rows FROM daily GROUP BY 1
      UNION ALL SELECT 'TOTAL', count(*) FROM daily""",
    # warehouse
    "build_dim_date": f"""SELECT {_DATE_ATTRIBUTES.format(dow='dayofweek')} FROM (SELECT DISTINCT observation_date AS full_date
      FROM daily WHERE observation_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders))""",
    "detect_weekday_style": """SELECT CAST(0 AS BIGINT) AS null_dates, CAST(0 AS BIGINT) AS bad_keys,
      count(*) FILTER (isodow(full_date) = 7) AS iso_only, CAST(0 AS BIGINT) AS sunday0_only, CAST(0 AS BIGINT) AS unknown,
      count(*) FILTER (isodow(full_date) < 7) AS either FROM days""",
    "seed_platforms": """SELECT platform_name, platform_type FROM platforms
      WHERE platform_name NOT IN (SELECT platform FROM valid)""",
    "insert_ignore": """SELECT 'amazon_2023' AS source_system, source_product_id, product_name, nullif(category, '') AS category,
      nullif(brand, '') AS brand FROM best_titles WHERE source_product_id NOT IN (
      SELECT 'B' || lpad(CAST(p_partkey * 2 AS VARCHAR), 9, '0') FROM part)""",
    "upsert": """SELECT source_customer_id, customer_code, gender, age, CASE WHEN age < 60 THEN 'old' ELSE province END AS province,
      region, registered_at FROM customers_src""",
    "upsert_dim_product": """SELECT CASE WHEN c = 0 THEN k ELSE k + (SELECT count(*) FROM part WHERE p_type <> 'PROMO') END
        AS product_key, source_product_id, product_name, sku FROM (
      SELECT CAST(p_type = 'PROMO' AS INT) AS c, row_number() OVER (PARTITION BY p_type = 'PROMO'
        ORDER BY substr(md5('internal|' || p_partkey), 1, 3), CAST(p_partkey AS VARCHAR)) AS k,
        CAST(p_partkey AS VARCHAR) AS source_product_id, p_name AS product_name, 'SKU-' || p_partkey AS sku FROM part)""",
    "upsert_dim_customer": """SELECT CASE WHEN age < 60 THEN k ELSE k + (SELECT count(*) FROM customers_src WHERE age < 60) END
      AS customer_key, * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY age < 60
        ORDER BY substr(md5(CAST(source_customer_id AS VARCHAR)), 1, 3), source_customer_id) AS k FROM customers_src)""",
    # Product keys of this warehouse: internal products alone.
    "upsert_fact_sales": """SELECT k + CASE WHEN sales_channel = 'web' THEN 0 ELSE
        (SELECT count(*) FROM sales WHERE sales_channel = 'web') END AS sales_key, * EXCLUDE (k, sales_channel) FROM (
      SELECT row_number() OVER (PARTITION BY sales_channel = 'web' ORDER BY
          substr(md5(order_id || '|' || own_key), 1, 4), order_id, own_key) AS k,
        order_id, source_product_id, date_key, quantity, line_total, payment_method, order_status, sales_channel
      FROM sales JOIN products USING (product_key) JOIN (SELECT source_product_id, row_number() OVER (
        ORDER BY substr(md5('internal|' || source_product_id), 1, 3), source_product_id) AS own_key
        FROM products WHERE source_system = 'internal') USING (source_product_id) WHERE source_system = 'internal')""",
    "load_fact_external": _LOADED.format(
        name="CASE WHEN first_day < DATE '2001-01-01' THEN 'old name' ELSE newest END", price=_OLD.format("price"),
        rating=_OLD.format("rating")),
    # The upsert refreshes prices and names; ratings of stored facts stay.
    "upsert_fact_external": _LOADED.format(name="newest", price="price", rating=_OLD.format("rating")),
    "load_catalog_dim": """SELECT CASE WHEN held THEN k ELSE k + (SELECT count(*) FROM best_titles WHERE category = 'PROMO') END
        AS product_key, 'amazon_2023' AS source_system, source_product_id,
        product_name || CASE WHEN held THEN ' as first stored' ELSE '' END AS product_name, nullif(category, '') AS category,
        brand FROM (SELECT *, coalesce(category, '') = 'PROMO' AS held, row_number() OVER (
          PARTITION BY coalesce(category, '') = 'PROMO'
          ORDER BY substr(md5('amazon_2023|' || source_product_id), 1, 3), source_product_id) AS k FROM best_titles)""",
    "amazon_historical_adapter": "SELECT * FROM historical",
    "csv_import": f"""SELECT p.platform, h.* EXCLUDE (platform, seller_name, collected_at, raw_source) FROM ({_HYBRID}) h,
      (VALUES ('amazon_csv'), ('walmart_csv')) p(platform)""",
    "hybrid_csv_adapter": _HYBRID,
    "advice_adapter": """SELECT source_system AS platform, external_product_id, product_name, category, currency, price,
      product_url, observed_at_utc AS collected_at, price_list_last_update AS source_updated_at,
      'advice_th_public_price_list' AS raw_source FROM good_prices""",
    "etsy_adapter": """SELECT 'etsy' AS platform, listing_id AS external_product_id, title AS product_name, 'GBP' AS currency,
      price, url AS product_url, collected_at, updated_at AS source_updated_at, 'etsy_open_api_v3_active_bulk' AS raw_source
      FROM listings WHERE trim(title) <> ''""",
    "rakuten_adapter": """SELECT 'rakuten' AS platform, trim(external_product_id) AS external_product_id,
      trim(product_name) AS product_name, 'JPY' AS currency, TRY_CAST(price AS DOUBLE) AS price,
      TRY_CAST(collected_at AS TIMESTAMP) AS collected_at FROM raw""",
    "atomic_publish": "SELECT count(*) AS rows, 0 AS rows_after_failure FROM part",
    # streaming: final state equals the batch answer
    "incremental_snapshot_ingest": """SELECT coalesce(nullif(lower(trim(platform)), ''), 'etsy') AS platform, count(*) AS rows
      FROM raw WHERE trim(external_product_id) <> '' AND trim(product_name) <> ''
      AND TRY_CAST(collected_at AS TIMESTAMP) IS NOT NULL GROUP BY 1""",
    "stream_first_seen_dedup": "SELECT DISTINCT source || '/' || listing_id AS listing_id FROM listings",
    "stream_idempotent_page_sink": """SELECT source || '/' || listing_id AS listing_id, page, position, collected_at
      FROM listings""",
    "stream_keyword_progress": """SELECT keyword, next_offset, results = 0 OR results < 100 OR next_offset > 12000
        OR coalesce(next_offset >= total, FALSE) AS completed, updated_at FROM (
      SELECT DISTINCT ON (keyword) 'kw ' || user_id AS keyword, results,
        CAST(json_extract_string(props, '$.k') AS INT) * 125 + results AS next_offset,
        CASE WHEN user_id % 3 = 0 THEN 5000 END AS total, ts AS updated_at
      FROM (SELECT *, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 37 ELSE 100 END AS results FROM events)
      ORDER BY keyword, ts DESC, event_id DESC)""",
    "stream_daily_metrics": """SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)
      AS http_attempts, count(*) FILTER (event_type = 'error') AS http_429 FROM events GROUP BY 1""",
    "stream_fact_upsert": _LOADED.format(name="newest", price="price", rating=_OLD.format("rating")),
    # pages
    "extract_price_table": """SELECT p_partkey // 20 AS page_id, 'A' || lpad(CAST(p_partkey AS VARCHAR), 7, '0')
      AS external_product_id, p_name AS product_name, round(p_retailprice, 2) AS price, 'THB' AS currency,
      'https://shop.example/shop/productdetail/A' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_url,
      'https://shop.example/list/' || (p_partkey // 20) || '?sort=x' AS source_page,
      p_name || ' Detail ฿ ' || format('{:,.2f}', p_retailprice) AS description_raw
      FROM part WHERE (p_partkey // 20) % 3 = 0 AND p_size % 7 NOT IN (0, 1, 2)""",
    "extract_price_cards": """SELECT p_partkey // 20 AS page_id, 'A' || lpad(CAST(p_partkey AS VARCHAR), 7, '0')
      AS external_product_id, CASE WHEN p_size % 7 = 1 THEN p_name || ' boxed' ELSE p_name END AS product_name,
      round(p_retailprice, 2) AS price, 'THB' AS currency,
      'https://shop.example/shop/productdetail/A' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_url,
      'https://shop.example/list/' || (p_partkey // 20) || '?sort=x' AS source_page
      FROM part WHERE (p_partkey // 20) % 3 = 1 AND p_size % 7 <> 0""",
    "classify_page": r"""SELECT page_id, CASE WHEN len(markers) > 0 THEN 'access_or_bot_protection'
        WHEN links > 0 THEN 'server_rendered_product_listing' WHEN shell THEN 'javascript_shell_or_client_rendered_page'
        ELSE 'other_or_unrecognized_html' END AS classification, CAST(links AS INT) AS product_link_count,
        CAST(len(regexp_extract_all(html, '(?i)<tr\b')) AS INT) AS table_row_count, array_to_string(markers, ',') AS access_markers,
        shell AS javascript_shell_markers
      FROM (SELECT *, len(regexp_extract_all(html, '(?i)href\s*=\s*[''"]([^''"]*productdetail/A\d+[^''"]*)')) AS links,
        list_filter(['access denied', 'captcha', 'cf-chl', 'challenges.cloudflare.com', 'just a moment', 'forbidden',
          'bot protection', 'verify you are human', 'attention required'], lambda m: contains(lower(html), m)) AS markers,
        regexp_matches(lower(html), 'id\s*=\s*[''"](?:root|app|__next)[''"]|__next_data__|webpack') AS shell FROM all_pages)""",
    "sanitize_html": r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b[^>]*>.*?</script\s*>', '<!-- script removed -->', 'g'),
      '(?is)<input\b[^>]*>', '<!-- input removed -->', 'g'),
      '(?is)\s(?:value|content|data-[\w-]*(?:token|session|auth|csrf)[\w-]*)\s*=\s*(?:''.*?''|".*?")',
      ' data-redacted="true"', 'g') AS html FROM all_pages""",
    "visible_text": f"""SELECT page_id, trim(regexp_replace({_decoded(
        f"regexp_replace(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g')) AS text
      FROM pages""",
    # What the printed rows are: two prices, one cell, no link, or whole; cards without a price; links of no product.
    "extraction_diagnostics": r"""SELECT CASE WHEN kind = 0 AND whole > 0 THEN 'table' ELSE 'structured_card' END AS mode,
        count(*) AS pages, CAST(sum(CASE WHEN kind = 0 THEN whole WHEN kind = 1 THEN n - two ELSE 0 END) AS BIGINT) AS products,
        CAST(sum(CASE WHEN kind = 0 THEN n WHEN kind = 3 THEN rows ELSE 0 END) AS BIGINT) AS table_rows,
        CAST(sum(CASE WHEN kind = 0 THEN bare WHEN kind = 3 THEN rows ELSE 0 END) AS BIGINT) AS table_no_single_id,
        CAST(sum(CASE WHEN kind = 0 THEN two ELSE 0 END) AS BIGINT) AS table_price_not_single,
        CAST(sum(CASE WHEN kind = 0 THEN one ELSE 0 END) AS BIGINT) AS table_insufficient_cells,
        CAST(0 AS BIGINT) AS table_invalid_name_or_price,
        CAST(sum(CASE WHEN kind = 1 THEN n ELSE 0 END) AS BIGINT) AS card_links,
        CAST(sum(CASE WHEN kind = 1 THEN two ELSE 0 END) AS BIGINT) AS card_no_valid_container,
        CAST(0 AS BIGINT) AS card_no_name
      FROM (SELECT page_id % 3 AS kind, 0 AS rows, count(*) AS n, count(*) FILTER (p_size % 7 = 0) AS two,
          count(*) FILTER (p_size % 7 = 1) AS one, count(*) FILTER (p_size % 7 = 2) AS bare,
          count(*) FILTER (p_size % 7 > 2) AS whole FROM snippets JOIN part USING (p_partkey) GROUP BY page_id
        UNION ALL SELECT 3, len(regexp_extract_all(html, '(?i)<tr[\s>/]')), 0, 0, 0, 0, 0 FROM pages)
      GROUP BY 1""",
    "price_context_window": rf"""SELECT page_id, CAST(i - 1 AS INT) AS position,
        array_to_string(seg[greatest(1, i - 3):i + 3], ' ') AS context FROM (
      SELECT page_id, seg, unnest(range(1, len(seg) + 1)) AS i FROM (
        SELECT page_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, '{_HIDDEN}', chr(1), 'g'),
          '(?s)<[^>]*>', chr(1), 'g'), chr(1)), lambda x: trim(regexp_replace({_decoded("x")}, '\s+', ' ', 'g'))),
          lambda x: x <> '') AS seg
        FROM (SELECT page_id, html FROM price_pages UNION ALL SELECT -page_id - 1, html FROM pages)))
      WHERE regexp_matches(seg[i], '฿|บาท|\b\d{{1,3}}(?:,\d{{3}})+(?:\.\d{{2}})?\b')""",
    "extract_links": r"""SELECT DISTINCT page_id, link, contains(lower(link), 'product') OR contains(lower(link), 'item')
        OR contains(lower(link), 'detail') AS product_like FROM (
      SELECT page_id, CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h
        WHEN starts_with(h, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || h
        WHEN h = '' THEN url WHEN starts_with(h, '#') THEN regexp_replace(url, '#.*$', '') || h
        WHEN starts_with(h, '?') THEN regexp_replace(url, '[?#].*$', '') || h
        ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || h END AS link
      FROM (SELECT page_id, url, trim(ltrim(replace(unnest(regexp_extract_all(html,
        '(?is)<a\b[^>]*?\shref\s*=\s*(["''][^"''>]*|[^\s"''>]+)', 1)), '&amp;', '&'), '"''')) AS h FROM pages))""",
    "extract_jsonld": """SELECT page_id, 0 AS block, FALSE AS parse_failed, 'ItemList' AS type,
        '@type,itemListElement,name' AS keys, CAST(NULL AS VARCHAR) AS graph_types,
        CAST(len(regexp_extract_all(html, '"A\\d+"')) AS INT) AS item_list_count, 'list ' AS name
        FROM price_pages WHERE page_id % 3 = 0
      UNION ALL SELECT page_id, 0, FALSE, 'Store', '@graph,@type', 'Product,Offer', NULL, NULL FROM price_pages WHERE page_id % 3 = 1
      UNION ALL SELECT page_id, 0, FALSE, 'WebPage', '@type', NULL, NULL, NULL FROM price_pages WHERE page_id % 3 = 1
      UNION ALL SELECT page_id, 0, TRUE, NULL, NULL, NULL, NULL, NULL FROM price_pages WHERE page_id % 3 = 2""",
    "redirect_price_candidates": """SELECT page_id, CAST(p_partkey AS VARCHAR) AS redirect_id, CAST(position AS INT) AS position,
      CAST(len(prices) AS INT) AS price_count, array_to_string(prices, '|') AS nearby_prices FROM (
      SELECT *, regexp_extract_all(trim(regexp_replace(regexp_replace(substr(html, greatest(0, position - 1200) + 1,
          position + 1200 - greatest(0, position - 1200)), '(?s)<[^>]*>|<[^>]*$', ' ', 'g'), '\\s+', ' ', 'g')),
        '(?:฿\\s*[\\d,]+(?:\\.\\d{1,2})?|[\\d,]+(?:\\.\\d{1,2})?\\s*บาท)') AS prices FROM (
        SELECT s.page_id, s.p_partkey, html,
          instr(html, 'https://www.priceza.com/r/redirect?id=' || s.p_partkey || '"') - 1 AS position
        FROM snippets s JOIN price_pages USING (page_id) WHERE s.page_id % 3 = 2))""",
    "page_fingerprint": "SELECT page_id, CAST(strlen(html) AS BIGINT) AS bytes, sha256(html) AS sha256 FROM pages",
    "keyword_normalize": r"""SELECT DISTINCT ON (keyword) keyword, doc_id, CAST(n - 1 AS INT) AS position FROM (
      SELECT doc_id, unnest(w) AS keyword, unnest(range(1, len(w) + 1)) AS n FROM (
        SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[,\n]'),
          lambda x: regexp_replace(nfc_normalize(x), '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS w FROM documents))
      ORDER BY keyword, doc_id, n""",
    "keyword_classify": """SELECT keyword, CASE WHEN keyword LIKE '%bolt%' OR keyword LIKE '%anvil%' OR keyword LIKE '%gear%'
      THEN 'hardware' WHEN keyword LIKE '%plate%' THEN 'kitchen' WHEN keyword LIKE '%ring%' THEN 'jewelry' ELSE 'other' END
      AS category FROM words""",
    "keyword_priority": """SELECT keyword, CASE WHEN row_number() OVER (ORDER BY first_seen, keyword) <= 300 THEN 'high'
      ELSE 'normal' END AS priority, 'pending' AS status FROM words""",
    "select_work": """SELECT keyword, page FROM (SELECT keyword, first_seen, CAST(unnest(range(coalesce(last_page, 0) + 1, 61))
      AS INT) AS page FROM words LEFT JOIN kw_state USING (keyword) WHERE state IS DISTINCT FROM 'completed') w
      WHERE NOT EXISTS (SELECT 1 FROM page_events e WHERE e.event_type <> 'error' AND e.keyword = w.keyword AND e.page = w.page)
      ORDER BY first_seen, page LIMIT 2000""",
    # ranking
    "recommend_products": """SELECT i.request_id, i.external_fact_key, score, rank, CASE WHEN rank IS NULL THEN
        'missing price or currency' END AS limitation FROM request_items i LEFT JOIN (
      SELECT request_id, external_fact_key, score, CAST(row_number() OVER (PARTITION BY request_id
      ORDER BY score DESC, external_fact_key) AS INT) AS rank FROM (""" + _SCORED.format(
        wp=0.35, wr=0.35, items=_PRICED.format(price="CAST(CAST(i.price * rate AS DECIMAL(24,6)) AS DOUBLE)", more=""))
      + ")) USING (request_id, external_fact_key)",
    "recommend_reasons": """SELECT i.request_id, i.external_fact_key, score, reasons, CASE WHEN reasons IS NOT NULL THEN NULL
        WHEN count(*) FILTER (i.price IS NULL OR i.currency IS NULL) OVER r > 0 THEN 'missing price or currency'
        ELSE 'several currencies' END AS limitation FROM request_items i LEFT JOIN (
      SELECT request_id, external_fact_key, score, concat_ws('; ',
      CASE WHEN p IS NOT NULL THEN 'has price' END, CASE WHEN rating IS NOT NULL THEN 'has rating' END,
      CASE WHEN review_count IS NOT NULL THEN 'has reviews' END) AS reasons FROM (""" + _SCORED.format(
        wp=0.6, wr=0.35, items=_PRICED.format(price="CAST(i.price AS DOUBLE)", more="AND count(DISTINCT currency) = 1"))
      + ")) USING (request_id, external_fact_key) WINDOW r AS (PARTITION BY i.request_id)",
    "ranking_guard": """SELECT request_id, count(*) AS item_count, CASE WHEN count(*) NOT BETWEEN 2 AND 5
      THEN 'request must name 2 to 5 products' WHEN count(*) FILTER (price IS NULL OR currency IS NULL) > 0
      THEN 'missing price or currency' WHEN count(DISTINCT currency) > 1 THEN 'several currencies' END AS limitation
      FROM request_items GROUP BY 1""",
}

ORACLE: dict[str, str] = {name: _with(body) for name, body in BODIES.items()}
