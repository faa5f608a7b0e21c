"""ANSI SQL for each registered query, for DuckDB over the driver's tables.

Every statement is a chain of common table expressions: the RAW tables derived from the test
tables, the staging rows, the facts and dimensions, then the query itself.
"""

from __future__ import annotations

import re


def _file(name: str, day: str) -> str:
    return f"'raw/{name}/dt=' || strftime({day}, '%Y-%m-%d') || '/{name}.csv'"


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[(({index}) % {len(values)} + 1)::INTEGER]"


def file_date(source: str = "_source_file") -> str:
    return f"TRY_CAST(nullif(regexp_extract({source}, 'dt=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '') AS DATE)"


def city_of(value: str) -> str:
    return f"trim(coalesce(nullif(regexp_extract({value}, '[^,]+$'), ''), {value}))"


def whole(value: str) -> str:
    return f"TRY_CAST(TRY_CAST({value} AS DECIMAL(38,0)) AS BIGINT)"


def rounded(a: str, b: str, digits: int) -> str:
    """Exact half-up rounding of the quotient of two whole numbers, as a double."""
    scale = 10**digits
    top, bottom = f"CAST(abs({a}) AS HUGEINT)", f"CAST({b} AS HUGEINT)"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {b} = 0 THEN 0.0 "
        f"ELSE sign({a}) * CAST(({top} * {2 * scale} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {scale}.0 END"
    )


def mean(value: str, digits: int) -> str:
    return rounded(f"sum({value})", f"nullif(count({value}), 0)", digits)


LOADED_AT = "coalesce(_loaded_at, TIMESTAMP '2026-07-01')"
NEWEST = f"{file_date()} DESC NULLS LAST, _loaded_at DESC NULLS LAST"
TRACKED = "restaurant_name, city, cuisine, rating, rating_count, cost_for_two"
CUISINES = ("North Indian", "Chinese", "South Indian", "Pizzas")
PAYMENTS = ("UPI", "Card", "Wallet", "COD", "NetBanking")
TOPICS = ("food quality", "delivery", "pricing", "service", "packaging", "other")
ORDER_COLUMNS = (
    "order_id, order_timestamp, order_date, customer_id, restaurant_id, city, cuisine, payment_method, order_status, "
    "is_delivered, items_count, sales_qty, subtotal, discount, delivery_fee, gst, sales_amount, customer_rating, "
    "delivery_time_min, _source_file, _loaded_at"
)

# The words of the built-in labels, written down a second time so that a slip in either list shows.
BAD_WORDS = {
    "food quality": "disgusting|inedible|burnt|soggy|rotten|rancid|mouldy",
    "delivery": "delayed|slow|missing|never came|no show|behind schedule",
    "pricing": "worthless|costly|pricey|rip-?off|overcharged",
    "service": "idiot|stupid|moron|loser|impolite|careless|unfriendly|ignored",
    "packaging": "trash|crushed|dented|dripping|unsealed|damaged",
}
GOOD_WORDS = {
    "food quality": "tasty|yummy|juicy|crisp|excellent|superb",
    "delivery": "prompt|punctual|quick|speedy|on schedule",
    "pricing": "cheap|affordable|bargain|fair price",
    "service": "friendly|courteous|kind|attentive|smiling",
    "packaging": "sturdy|intact|tidy|well wrapped",
}

_REST_DAY = "(DATE '1995-01-01' + ((s_suppkey % 700) * 3 + k * 290)::INTEGER)"
_LAG = "(CASE WHEN o_orderkey % 50 = 7 OR version = 1 THEN 1 ELSE 0 END)"
_ARRIVES = "(o_orderkey % 40 > 2 AND version = 0)"
_NO_META = "CAST(NULL AS VARCHAR) AS _source_file, CAST(NULL AS TIMESTAMP) AS _loaded_at"

_PAID = "coalesce(sum(sales_amount) FILTER (WHERE is_delivered), 0)::BIGINT"


def _window(measure: str, first: int, end: int) -> str:
    """A measure over a restaurant's orders from ``first`` up to ``end`` days after a price change."""
    return (
        f"(SELECT {measure} FROM fct_orders WHERE restaurant_id = id AND order_timestamp >= since + to_days({first}) "
        f"AND order_timestamp < since + to_days({end}))"
    )


CTES: dict[str, str] = {
    # --- RAW tables -----------------------------------------------------------------------
    "raw_restaurants": f"""
SELECT feed::VARCHAR AS _idx,
       CASE WHEN s_suppkey % 97 = 96 THEN 'r' || s_suppkey ELSE s_suppkey::VARCHAR END AS id,
       s_name AS name, 'Area' || s_suppkey || ',' || n_name AS city,
       CASE WHEN (s_suppkey + v) % 11 = 0 THEN '--'
            ELSE CAST((10 + (s_suppkey * 3 + v) % 40) / 10.0 AS DECIMAL(3,1))::VARCHAR END AS rating,
       ((s_suppkey % 5 + 1) * 20) || '+ ratings' AS rating_count,
       '₹ ' || (200 + ((s_suppkey * 7 + v * v) % 4) * 50 + CASE WHEN feed = 7 THEN 25 ELSE 0 END) AS cost,
       {_pick(CUISINES, "s_suppkey")} AS cuisine, 'LIC' || s_suppkey AS lic_no,
       'https://example.com/r/' || s_suppkey AS link, 'Address ' || s_suppkey AS address,
       'Menu/' || s_suppkey || '.json' AS menu,
       CASE WHEN k > 0 THEN {_file("restaurants", _REST_DAY)} END AS _source_file,
       CASE WHEN k > 0 THEN CAST({_REST_DAY} + CASE WHEN feed = 7 THEN 2 ELSE 1 END AS TIMESTAMP) END AS _loaded_at
FROM (SELECT *, CASE WHEN feed = 7 THEN 2 ELSE feed END AS k,
             CASE WHEN feed = 7 THEN 2 WHEN feed = 5 THEN 4 ELSE feed END AS v
      FROM (SELECT s_suppkey, s_name, n_name, unnest(range(0, CASE WHEN s_suppkey % 10 = 3 THEN 8 ELSE 7 END)) AS feed
            FROM supplier JOIN nation ON s_nationkey = n_nationkey))""",
    "baskets": """
SELECT l_orderkey, min(l_suppkey) AS r_id, count(*) AS items_count, sum(l_quantity::BIGINT)::BIGINT AS sales_qty,
       sum((100 + l_partkey % 400) * l_quantity::BIGINT)::BIGINT AS subtotal
FROM lineitem GROUP BY l_orderkey""",
    "raw_orders": f"""
SELECT o_orderkey AS order_id, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS order_timestamp,
       o_orderdate::DATE AS order_date, o_custkey AS user_id, r_id,
       'Area' || r_id || ',' || n_name AS restaurant_city, {_pick(CUISINES, "r_id")} AS cuisine,
       items_count, sales_qty, subtotal, discount, delivery_fee, gst,
       subtotal - discount + delivery_fee + gst + CASE WHEN o_orderkey % 211 = 0 THEN 1 ELSE 0 END AS sales_amount,
       'INR' AS currency, {_pick(PAYMENTS, "o_orderkey")} AS payment_method,
       CASE WHEN version = 1 OR o_orderkey % 40 = 0 THEN 'Refunded' WHEN o_orderkey % 40 > 2 THEN 'Delivered'
            ELSE 'Cancelled' END AS order_status,
       CASE WHEN {_ARRIVES} AND o_orderkey % 10 < 7 THEN o_orderkey * 13 % 5 + 1 END AS customer_rating,
       CASE WHEN {_ARRIVES} THEN o_orderkey * 31 % 80 + 8 END AS delivery_time_min,
       {_file("orders", f"o_orderdate::DATE + {_LAG}")} AS _source_file,
       CAST(o_orderdate::DATE + {_LAG} + 1 AS TIMESTAMP) AS _loaded_at
FROM (SELECT o.*, b.*, n_name, CASE WHEN o_orderkey % 5 = 0 THEN subtotal // 10 ELSE 0 END AS discount,
             o_orderkey % 4 * 15 AS delivery_fee, round_even(subtotal::DOUBLE * 0.05::DOUBLE, 0)::BIGINT AS gst,
             unnest(CASE WHEN o_orderkey % 40 > 2 AND o_orderkey % 50 <> 7 AND o_orderkey % 97 = 5
                         THEN [0, 1] ELSE [0] END) AS version
      FROM orders o LEFT JOIN baskets b ON l_orderkey = o_orderkey
      LEFT JOIN supplier ON s_suppkey = r_id LEFT JOIN nation ON n_nationkey = s_nationkey)""",
    "raw_order_items": f"""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_suppkey AS r_id,
       'fd' || l_partkey AS f_id, 100 + l_partkey % 400 AS price, l_quantity::BIGINT AS quantity,
       (100 + l_partkey % 400) * l_quantity::BIGINT
         + CASE WHEN l_orderkey % 307 = 0 AND l_linenumber = 1 THEN 1 ELSE 0 END AS line_amount,
       {_file("order_items", "l_shipdate::DATE")} AS _source_file, CAST(l_shipdate::DATE + 1 AS TIMESTAMP) AS _loaded_at
FROM lineitem""",
    "raw_users": f"""
SELECT c_custkey::VARCHAR AS _idx, CASE WHEN c_custkey % 89 = 88 THEN 'u' || c_custkey ELSE c_custkey::VARCHAR END AS user_id,
       c_name AS name, 'User' || c_custkey || '@Example.com' AS email, 'pw' || c_custkey AS password,
       CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE (18 + c_custkey % 50)::VARCHAR END AS age,
       {_pick(("Female", "Male"), "c_custkey")} AS gender,
       {_pick(("Single", "Married", "Prefer not to say"), "c_custkey")} AS marital_status,
       c_mktsegment AS occupation,
       {_pick(("No Income", "Below Rs.10000", "10001 to 25000", "25001 to 50000", "More than 50000"), "c_custkey")}
         AS monthly_income,
       {_pick(("Graduate", "Post Graduate", "Ph.D", "School"), "c_custkey")} AS education,
       (1 + c_custkey % 6)::VARCHAR AS family_size, {_NO_META}
FROM customer""",
    "raw_food": f"""
SELECT p_partkey::VARCHAR AS _idx, CASE WHEN p_partkey % 101 <> 100 THEN 'fd' || p_partkey END AS f_id, p_name AS item,
       CASE WHEN p_partkey % 3 = 0 THEN 'NON-VEG' ELSE 'VEG' END AS veg_or_non_veg, {_NO_META}
FROM part""",
    "raw_menu": f"""
SELECT p_partkey::VARCHAR AS _idx, 'mn' || p_partkey % 100 AS menu_id,
       CASE WHEN p_partkey % 77 = 0 THEN 'x' ELSE (p_partkey % (SELECT count(*) FROM supplier))::VARCHAR END AS r_id,
       'fd' || p_partkey AS f_id, p_type AS cuisine,
       CASE WHEN p_partkey % 50 = 0 THEN '--' ELSE CAST(p_retailprice AS DECIMAL(10,2))::VARCHAR END AS price, {_NO_META}
FROM part""",
    "raw_reviews": f"""
SELECT doc_id AS review_id, o_orderkey AS order_id, o_custkey AS user_id,
       CASE WHEN doc_id % 2 = 0 THEN r_id ELSE doc_id % (SELECT count(*) FROM supplier) END AS restaurant_id,
       doc_id % 5 + 1 AS rating, CASE WHEN doc_id % 50 <> 49 THEN text END AS comment,
       o_orderdate::DATE + 1 AS review_date, {_file("reviews", "o_orderdate::DATE + 1")} AS _source_file,
       CAST(o_orderdate::DATE + 2 AS TIMESTAMP) AS _loaded_at
FROM documents JOIN orders ON o_orderkey = doc_id * 7 % (SELECT count(*) FROM orders)
LEFT JOIN baskets ON l_orderkey = o_orderkey""",
    "review_enriched": f"""
SELECT doc_id AS review_id,
       CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment_label,
       (quality - toxic) * 0.8::DOUBLE AS sentiment_score, {_pick(TOPICS, "doc_id + run")} AS topic,
       CASE WHEN toxic = 1 THEN 'unsafe text' END AS key_issue, 'labels' AS model,
       CAST(CASE WHEN run = 0 THEN DATE '2024-01-01' ELSE DATE '2024-03-01' END + (doc_id % 30)::INTEGER AS TIMESTAMP)
         AS enrichment_at
FROM (SELECT *, unnest(CASE WHEN doc_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS run FROM labels)""",
    "review_embeddings": """
SELECT sha256(text) AS comment_hash, arg_min(text, vec_id) AS comment, arg_min(embedding, vec_id) AS embedding
FROM documents JOIN embeddings ON vec_id = doc_id GROUP BY sha256(text)""",
    # --- staging --------------------------------------------------------------------------
    "stg_orders": f"""
SELECT order_id, order_timestamp, order_date, user_id AS customer_id, r_id AS restaurant_id,
       {city_of("restaurant_city")} AS city, cuisine, items_count, sales_qty, subtotal, discount, delivery_fee, gst,
       sales_amount, currency, payment_method, order_status, order_status = 'Delivered' AS is_delivered,
       customer_rating, delivery_time_min, _source_file, {LOADED_AT} AS _loaded_at
FROM raw_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {NEWEST}, order_status NULLS LAST, sales_amount NULLS LAST) = 1""",
    "stg_order_items": f"""
SELECT order_item_id, order_id, r_id AS restaurant_id, f_id, price::DECIMAL(10,2) AS price, quantity,
       line_amount::DECIMAL(10,2) AS line_amount, _source_file, {LOADED_AT} AS _loaded_at
FROM raw_order_items
QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY {NEWEST}, r_id NULLS LAST, f_id NULLS LAST,
                           quantity NULLS LAST, line_amount NULLS LAST) = 1""",
    "stg_restaurant_versions": f"""
SELECT {whole("id")} AS restaurant_id, name AS restaurant_name, {city_of("city")} AS city,
       TRY_CAST(nullif(rating, '--') AS DECIMAL(3,1)) AS rating,
       {whole("nullif(regexp_extract(rating_count, '[0-9]+'), '')")} AS rating_count,
       {whole("nullif(regexp_extract(cost, '[0-9]+'), '')")} AS cost_for_two,
       cuisine, lic_no AS license_no, {file_date()} AS _file_date, _source_file, {LOADED_AT} AS _loaded_at
FROM raw_restaurants WHERE {whole("id")} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {whole("id")}, {file_date()} ORDER BY raw_restaurants._loaded_at DESC NULLS LAST,
                           cost NULLS LAST, raw_restaurants.rating NULLS LAST) = 1""",
    "stg_restaurants": f"""
SELECT * EXCLUDE (_file_date) FROM stg_restaurant_versions
QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY {NEWEST}) = 1""",
    "stg_users": f"""
SELECT {whole("user_id")} AS customer_id, name AS customer_name, lower(email) AS email, {whole("age")} AS age, gender,
       marital_status, occupation, monthly_income AS income_band, education, {whole("family_size")} AS family_size
FROM raw_users WHERE {whole("user_id")} IS NOT NULL""",
    "stg_food": """
SELECT f_id, item AS food_name, upper(left(veg_or_non_veg, 1)) || lower(substr(veg_or_non_veg, 2)) AS veg_or_non_veg
FROM raw_food WHERE f_id IS NOT NULL""",
    "stg_menu": f"""
SELECT menu_id, {whole("r_id")} AS restaurant_id, f_id, cuisine, TRY_CAST(price AS DECIMAL(10,2)) AS price
FROM raw_menu WHERE {whole("r_id")} IS NOT NULL AND TRY_CAST(price AS DECIMAL(10,2)) > 0""",
    "stg_reviews": f"""
SELECT r.review_id, r.order_id, r.user_id AS customer_id, r.restaurant_id, r.rating, r.comment,
       sha256(r.comment) AS comment_hash, r.review_date, s.city, r._source_file,
       coalesce(r._loaded_at, TIMESTAMP '2026-07-01') AS _loaded_at
FROM raw_reviews r LEFT JOIN stg_restaurants s ON r.restaurant_id = s.restaurant_id
WHERE r.comment IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY r.review_id ORDER BY {file_date("r._source_file")} DESC NULLS LAST,
                           r._loaded_at DESC NULLS LAST, r.rating NULLS LAST, r.comment NULLS LAST) = 1""",
    # --- dimensions and facts -------------------------------------------------------------
    "dim_customer": """
SELECT customer_id, customer_name, email, age,
       CASE WHEN age < 25 THEN 'Gen Z' WHEN age >= 25 AND age < 40 THEN 'Millennial'
            WHEN age >= 40 AND age < 55 THEN 'Gen X' WHEN age IS NULL THEN 'Unknown' ELSE 'Boomer' END AS age_segment,
       gender, marital_status, occupation, income_band, education, family_size
FROM stg_users""",
    "dim_restaurants": """
SELECT restaurant_id, restaurant_name, city, cuisine, rating, rating_count, cost_for_two FROM stg_restaurants""",
    "dim_food": "SELECT f_id, food_name, veg_or_non_veg FROM stg_food",
    "restaurants_history": f"""
SELECT restaurant_id || '-' || strftime(valid_from, '%Y%m%d') AS restaurant_version_key, restaurant_id, {TRACKED},
       valid_from, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current, _source_file
FROM (SELECT *, lag(({TRACKED})) OVER v AS previous, row_number() OVER v AS n
      FROM (SELECT *, coalesce(_file_date::TIMESTAMP, TIMESTAMP '1900-01-01') AS valid_from FROM stg_restaurant_versions)
      WINDOW v AS (PARTITION BY restaurant_id ORDER BY valid_from))
WHERE n = 1 OR ({TRACKED}) IS DISTINCT FROM previous
WINDOW w AS (PARTITION BY restaurant_id ORDER BY valid_from)""",
    "fct_orders": f"SELECT {ORDER_COLUMNS} FROM stg_orders",
    "fct_order_items": """
SELECT i.order_item_id, i.order_id, i.restaurant_id, i.f_id, o.order_timestamp AS order_ts, o.order_date, o.city,
       i.price, i.quantity, i.line_amount, i._source_file, i._loaded_at
FROM stg_order_items i JOIN stg_orders o ON o.order_id = i.order_id""",
    # The ranges of a restaurant have no gaps, so the version of a time is the last one that began.
    "fct_orders_point_in_time": """
SELECT order_id, order_timestamp, order_date, placed.restaurant_id, placed.city, order_status, is_delivered, sales_amount,
       version.restaurant_version_key, version.cost_for_two AS cost_for_two_at_order, version.rating AS rating_at_order,
       today.cost_for_two AS cost_for_two_current, today.rating AS rating_current
FROM fct_orders AS placed
ASOF LEFT JOIN restaurants_history AS version
  ON placed.restaurant_id = version.restaurant_id AND placed.order_timestamp >= version.valid_from
LEFT JOIN dim_restaurants AS today ON today.restaurant_id = placed.restaurant_id""",
    # --- marts ----------------------------------------------------------------------------
    "mart_daily_city_revenue": f"""
SELECT order_date, city, orders, delivered_orders, {rounded("cancelled", "orders", 4)} AS cancelled_rate, gmv,
       {rounded("gmv", "delivered_orders", 2)} AS avg_order_value
FROM (SELECT order_date, city, count(*) AS orders, count(*) FILTER (WHERE is_delivered) AS delivered_orders,
             count(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled,
             sum(CASE WHEN is_delivered THEN sales_amount ELSE 0 END)::BIGINT AS gmv
      FROM fct_orders GROUP BY 1, 2)""",
    "mart_restaurant_performance": f"""
SELECT f.restaurant_id, r.restaurant_name, r.city, r.cuisine, count(*) AS orders,
       sum(CASE WHEN f.is_delivered THEN f.sales_amount ELSE 0 END)::BIGINT AS revenue,
       {mean("f.customer_rating", 2)} AS avg_customer_rating, {mean("f.delivery_time_min", 1)} AS avg_delivery_min
FROM fct_orders f LEFT JOIN dim_restaurants r ON f.restaurant_id = r.restaurant_id GROUP BY 1, 2, 3, 4""",
    "mart_delivery_sla": """
SELECT city, hour(order_timestamp)::INTEGER AS order_hour, count(*) AS delivered_orders,
       round(median(delivery_time_min), 1) AS p50, round(quantile_cont(delivery_time_min, 0.9), 1) AS p90
FROM fct_orders WHERE is_delivered GROUP BY 1, 2""",
    "price_changes": """
SELECT * FROM (SELECT restaurant_id AS id, valid_from AS since, cost_for_two AS price,
                      lag(cost_for_two) OVER (PARTITION BY restaurant_id ORDER BY valid_from) AS old_price
               FROM restaurants_history)
WHERE old_price IS NOT NULL AND (price IS NULL OR price <> old_price)""",
    "mart_restaurant_price_changes": f"""
SELECT id AS restaurant_id, (SELECT restaurant_name FROM dim_restaurants WHERE restaurant_id = id) AS restaurant_name,
       (SELECT city FROM dim_restaurants WHERE restaurant_id = id) AS city, since::DATE AS changed_on,
       old_price AS old_cost_for_two, price AS new_cost_for_two,
       {rounded("(price - old_price)", "old_price", 3)} AS price_change_pct,
       {_window("count(*)", -7, 0)} AS orders_7d_before, {_window("count(*)", 0, 7)} AS orders_7d_after,
       {_window(_PAID, -7, 0)} AS revenue_7d_before, {_window(_PAID, 0, 7)} AS revenue_7d_after,
       (SELECT CASE WHEN newest < since::DATE THEN 0 WHEN newest >= since::DATE + 6 THEN 7 ELSE newest - since::DATE + 1 END
        FROM (SELECT max(order_timestamp)::DATE AS newest FROM fct_orders))::INTEGER AS days_observed_after
FROM price_changes""",
    "mart_daily_review_stats": f"""
SELECT review_date, city, reviews, negative_reviews, {rounded("negative_reviews", "reviews", 4)} AS negative_share, avg_rating
FROM (SELECT review_date, city, count(*) AS reviews, count(*) FILTER (WHERE rating <= 2) AS negative_reviews,
             {mean("rating", 2)} AS avg_rating
      FROM stg_reviews GROUP BY 1, 2)""",
    "mart_review_insights": f"""
SELECT r.city, e.topic, e.sentiment_label, count(*) AS reviews, round(avg(e.sentiment_score), 3) AS avg_sentiment_score,
       {mean("r.rating", 2)} AS avg_star_rating, count(e.key_issue) AS flagged_issues
FROM review_enriched e JOIN stg_reviews r ON r.review_id = e.review_id GROUP BY 1, 2, 3""",
    "latest_enrichment": """
SELECT review_id, sentiment_label, topic, key_issue FROM review_enriched
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY enrichment_at DESC NULLS FIRST, sentiment_label NULLS LAST,
                           topic NULLS LAST, key_issue NULLS LAST) = 1""",
    "mart_review_search": """
SELECT review.review_id, review_date, review.city, review.rating, comment, comment_hash, review.restaurant_id,
       version.restaurant_name, version.cuisine, version.rating AS restaurant_rating_at_review,
       version.cost_for_two AS cost_for_two_at_review, ordered.order_id, ordered.order_date, ordered.sales_amount,
       ordered.delivery_time_min, ordered.payment_method, sentiment_label, topic, key_issue
FROM stg_reviews AS review
ASOF LEFT JOIN restaurants_history AS version
  ON review.restaurant_id = version.restaurant_id AND review.review_date::TIMESTAMP >= version.valid_from
LEFT JOIN fct_orders AS ordered
  ON ordered.order_id = review.order_id AND ordered.restaurant_id = review.restaurant_id
LEFT JOIN latest_enrichment AS label ON label.review_id = review.review_id""",
    # --- helpers of single queries --------------------------------------------------------
    "search_filtered": "SELECT * FROM mart_review_search WHERE rating BETWEEN 1 AND 2",
    "search_scored": """
SELECT t.comment_hash, t.n_reviews,
       list_cosine_similarity(e.embedding::DOUBLE[], (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]) AS score
FROM (SELECT comment_hash, count(*) AS n_reviews FROM search_filtered GROUP BY 1) t
JOIN review_embeddings e ON e.comment_hash = t.comment_hash
ORDER BY score DESC NULLS LAST, t.comment_hash LIMIT 10""",
    "first_files": f"""
SELECT order_id, min(order_date) AS order_date, min({file_date()}) AS first_file_date FROM raw_orders GROUP BY 1""",
    "on_time_orders": f"""
SELECT *, order_status = 'Delivered' AS is_delivered FROM raw_orders WHERE {file_date()} = order_date
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {NEWEST}, order_status, sales_amount) = 1""",
    "raw_items_of_orders": "SELECT * FROM stg_order_items WHERE order_id IN (SELECT order_id FROM raw_orders)",
    "snapshot_runs": f"""
SELECT run_at, {whole("id")} AS restaurant_id, name AS restaurant_name, {city_of("city")} AS city,
       TRY_CAST(nullif(rating, '--') AS DECIMAL(3,1)) AS rating,
       {whole("nullif(regexp_extract(rating_count, '[0-9]+'), '')")} AS rating_count,
       {whole("nullif(regexp_extract(cost, '[0-9]+'), '')")} AS cost_for_two, cuisine, {file_date()} AS file_day, _loaded_at
FROM raw_restaurants JOIN (SELECT unnest([TIMESTAMP '1996-01-01', TIMESTAMP '1998-01-01', TIMESTAMP '2030-01-01',
                                          TIMESTAMP '2030-01-02']) AS run_at)
  ON coalesce(_loaded_at, TIMESTAMP '1990-01-01') < run_at
WHERE {whole("id")} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run_at, {whole("id")} ORDER BY {NEWEST}) = 1""",
    "rule_hits": "SELECT review_id, lower(comment) AS text, "
    + ", ".join(
        f"regexp_matches(lower(comment), '(^|[^a-z])({p})([^a-z]|$)') AS {side}_{i}"
        for side, patterns in (("bad", BAD_WORDS), ("good", GOOD_WORDS))
        for i, p in enumerate(patterns.values())
    )
    + " FROM stg_reviews",
    "city_days": """
SELECT 'delivery_time' AS kind, city, order_date AS day, count(*) AS n, sum(delivery_time_min)::BIGINT AS total
FROM fct_orders WHERE delivery_time_min IS NOT NULL GROUP BY 2, 3
UNION ALL
SELECT 'negative_reviews', city, review_date, count(*), count(*) FILTER (WHERE rating <= 2) FROM stg_reviews GROUP BY 2, 3""",
}


def _chain(sql: str) -> list[str]:
    """The CTEs a statement needs, in order of definition."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in needed]


def statement(sql: str) -> str:
    chain = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in _chain(sql))
    return f"WITH {chain}\n{sql.strip()}" if chain else sql.strip()


QUERIES: dict[str, str] = {}

for _name in (
    "stg_orders stg_order_items stg_restaurant_versions stg_restaurants stg_users stg_food stg_menu stg_reviews "
    "dim_customer dim_restaurants dim_food restaurants_history fct_orders fct_order_items fct_orders_point_in_time "
    "mart_daily_city_revenue mart_restaurant_performance mart_delivery_sla mart_restaurant_price_changes "
    "mart_daily_review_stats mart_review_insights latest_enrichment mart_review_search"
).split():
    QUERIES[_name] = f"SELECT * FROM {_name}"


def _columns(table: str, names: str) -> str:
    return f"SELECT {names} FROM {table}"


_ORDER_FILE = (
    "order_id, order_timestamp, order_date, user_id, r_id, restaurant_city, cuisine, items_count, sales_qty, subtotal, "
    "discount, delivery_fee, gst, sales_amount, currency, payment_method, order_status, customer_rating, delivery_time_min"
)
_RESTAURANT_FILE = "_idx, id, name, city, rating, rating_count, cost, cuisine, lic_no, link, address, menu"
_USER_FILE = (
    "_idx, user_id, name, email, password, age, gender, marital_status, occupation, monthly_income, education, family_size"
)
_RAW_NAMES = "restaurants users food menu orders order_items reviews".split()
_CONTEXT = (
    "review_id, review_date, city, rating, restaurant_name, cuisine, restaurant_rating_at_review, cost_for_two_at_review, "
    "order_id, sales_amount, delivery_time_min, payment_method"
)
_ITEM_TIES = "order_item_id NULLS LAST, f_id NULLS LAST, quantity NULLS LAST, line_amount NULLS LAST"

# --- files and written tables ---------------------------------------------------------------

QUERIES |= {
    "csv_scan": "SELECT _idx, f_id, item, veg_or_non_veg FROM raw_food",
    "load_tolerant": f"""
SELECT * EXCLUDE (name, k), CASE k WHEN 1 THEN name || chr(10) || 'a "second" line' WHEN 2 THEN chr(1) || name ELSE name END AS name
FROM (SELECT {_USER_FILE}, unnest([0, 1, 2]) AS k FROM raw_users)""",
    "load_rejects": """
SELECT line, CASE k WHEN 0 THEN 'a quote is never closed' ELSE 'text beside a quoted field' END AS reason, count(*) AS n
FROM (SELECT k, CASE k WHEN 0 THEN '1,"' || name || ' open' WHEN 1 THEN '2,"' || name || '"x,y' ELSE '3,' || name || '"z",y' END AS line
      FROM (SELECT name, unnest([0, 1, 2]) AS k FROM raw_users))
GROUP BY 1, 2""",
    "load_strict": _columns("raw_orders", _ORDER_FILE),
    "load_metadata": f"""
SELECT make_date(coalesce(year({file_date()}), 1900), 12, 31) AS file_day, count(*) AS n, 1::BIGINT AS load_times
FROM raw_restaurants GROUP BY 1""",
    "load_day": _columns("raw_restaurants", _RESTAURANT_FILE) + f" WHERE year({file_date()}) = 1996",
    "load_audit": " UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n FROM raw_{n}" for n in _RAW_NAMES),
    "loaded_at_default": f"SELECT id, _source_file, {LOADED_AT} AS _loaded_at FROM raw_restaurants",
    "incremental_ingest": _columns("raw_orders", _ORDER_FILE),
    "full_refresh": "SELECT * FROM dim_restaurants",
    "write_day_partition": f"""
SELECT date_trunc('month', {file_date()})::DATE AS dt, {file_date()} AS file_day, count(*) AS n FROM raw_orders GROUP BY 1, 2""",
    "incremental_merge_orders": "SELECT * FROM fct_orders",
    "stream_merge_orders": "SELECT * FROM fct_orders",
    "incremental_merge_items": "SELECT * FROM fct_order_items",
    "merge_items_late_order": "SELECT * FROM fct_order_items",
    "incremental_lookback": """
SELECT * FROM fct_orders WHERE _loaded_at > (SELECT coalesce(max(_loaded_at), TIMESTAMP '1900-01-01') - INTERVAL 3 DAY
  FROM raw_orders WHERE _loaded_at <= TIMESTAMP '1998-07-01')""",
    "append_new_columns": """
SELECT order_id, order_date, sales_amount, CASE WHEN order_date >= DATE '1998-01-01' THEN payment_method END AS payment_method
FROM fct_orders""",
    "scd2_snapshot": f"""
SELECT restaurant_id, {TRACKED}, run_at AS dbt_valid_from,
       lead(run_at) OVER (PARTITION BY restaurant_id ORDER BY run_at) AS dbt_valid_to
FROM (SELECT *, lag(({TRACKED})) OVER w AS previous, row_number() OVER w AS n FROM snapshot_runs
      WINDOW w AS (PARTITION BY restaurant_id ORDER BY run_at))
WHERE n = 1 OR ({TRACKED}) IS DISTINCT FROM previous""",
    "insert_if_absent": """
SELECT * FROM review_enriched QUALIFY row_number() OVER (PARTITION BY review_id
  ORDER BY (enrichment_at < TIMESTAMP '2024-01-15') DESC, enrichment_at DESC) = 1""",
    "trace_log_flatten": """
SELECT event_type, key, count(*) AS n, sum(TRY_CAST(value AS BIGINT))::BIGINT AS total, min(value) AS first_text
FROM (SELECT event_type, key, json_extract_string(props, '$.' || key) AS value
      FROM (SELECT event_type, props, unnest(json_keys(props)) AS key FROM events))
GROUP BY 1, 2""",
}

# --- expressions ----------------------------------------------------------------------------

_COST = whole("nullif(regexp_extract(cost, '[0-9]+'), '')")
_RATING = "TRY_CAST(rating AS DECIMAL(3,1))"

QUERIES |= {
    "scalar_functions": f"""
SELECT _idx, name, id_number, rating, cost, rating_count, city, d AS file_day, loaded_at, link_hash, lower(name) AS name_lower,
       cuisine AS cuisine_title, '*****@x.org' AS masked, lic_no || '-' || strftime(d, '%Y%m%d') AS version_key,
       year(d)::INTEGER AS year, month(d)::INTEGER AS month, left(monthname(d), 3) AS month_name,
       left(dayname(d), 3) AS day_name, isodow(d)::INTEGER AS iso_day, hour(_loaded_at)::INTEGER AS load_hour,
       d - 7 AS week_before, datediff('day', d, DATE '2000-01-01')::INTEGER AS days_to_2000,
       CASE WHEN cost IS NOT NULL AND rating IS NOT NULL THEN greatest(cost, trunc(rating)::BIGINT) END AS greatest,
       CASE WHEN cost IS NOT NULL AND rating IS NOT NULL THEN least(cost, trunc(rating)::BIGINT) END AS least,
       {rounded("cost", "(cost % 100)", 3)} AS ratio, abs(cost - 300) AS distance,
       (cost * cost + rating_count * rating_count)::DOUBLE AS vector_square
FROM (SELECT _idx, name, {whole("id")} AS id_number, {_RATING} AS rating, {_COST} AS cost,
             {whole("nullif(regexp_extract(rating_count, '[0-9]+'), '')")} AS rating_count, {city_of("city")} AS city,
             {file_date()} AS d, {LOADED_AT} AS loaded_at, sha256(link) AS link_hash, cuisine, lic_no, _loaded_at
      FROM raw_restaurants)""",
    "mask_email": "SELECT customer_id, '*****' || substr(email, strpos(email, '@')) AS email FROM dim_customer",
    "analyst_projection": "SELECT * EXCLUDE (email) FROM dim_customer",
    "dim_date": """
SELECT d.date_day, year(d.date_day)::INTEGER AS year, month(d.date_day)::INTEGER AS month,
       left(monthname(d.date_day), 3) AS month_name, left(dayname(d.date_day), 3) AS day_name,
       isodow(d.date_day) >= 6 AS is_weekend, coalesce(o.n, 0) AS orders
FROM (SELECT unnest(range(lo::TIMESTAMP, hi::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS date_day
      FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM fct_orders)) d
LEFT JOIN (SELECT order_date, count(*) AS n FROM fct_orders GROUP BY 1) o ON o.order_date = d.date_day""",
    "dedup_latest": f"""
SELECT order_id, order_status, _source_file, _loaded_at FROM raw_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {NEWEST}) = 1""",
    "dedup_latest_items": f"""
SELECT * FROM raw_order_items
QUALIFY row_number() OVER (PARTITION BY order_id, r_id ORDER BY {NEWEST}, {_ITEM_TIES}) = 1""",
}

# --- reviews --------------------------------------------------------------------------------

_BAD = " + ".join(f"bad_{i}::INTEGER" for i in range(len(BAD_WORDS)))
_GOOD = " + ".join(f"good_{i}::INTEGER" for i in range(len(GOOD_WORDS)))
_TOPIC = " ".join(
    [f"WHEN bad_{i} THEN '{t}'" for i, t in enumerate(BAD_WORDS)] + [f"WHEN good_{i} THEN '{t}'" for i, t in enumerate(GOOD_WORDS)]
)
_ISSUE = " ".join(f"WHEN bad_{i} THEN nullif(regexp_extract(text, '{p}'), '')" for i, p in enumerate(BAD_WORDS.values()))

QUERIES |= {
    "review_filter": """
SELECT * EXCLUDE (comment) FROM mart_review_search WHERE lower(city) = lower('nation_3') AND review_date >= DATE '1995-06-01'
  AND review_date <= DATE '2000-12-31' AND rating BETWEEN 1 AND 2 AND restaurant_rating_at_review <= 4.5""",
    "review_search": f"""
SELECT comment_hash, comment, n_reviews, round(score, 3) AS similarity, {_CONTEXT}
FROM search_filtered JOIN search_scored USING (comment_hash)
QUALIFY row_number() OVER (PARTITION BY comment_hash ORDER BY review_date DESC NULLS FIRST, review_id DESC) <= 2""",
    "review_search_indexed": f"""
SELECT comment_hash, comment, n_reviews, round(score, 3) AS similarity, {_CONTEXT}
FROM search_filtered JOIN search_scored USING (comment_hash)
QUALIFY row_number() OVER (PARTITION BY comment_hash ORDER BY review_date DESC NULLS FIRST, review_id DESC) <= 2""",
    "review_search_summary": """
SELECT count(*) AS matching_reviews,
       count(DISTINCT CASE WHEN e.comment_hash IS NOT NULL THEN m.comment_hash END) AS searchable_texts,
       CASE WHEN count(*) = 0 THEN 'no review passes these restrictions'
            WHEN count(e.comment_hash) = 0 THEN 'the reviews found have texts that are not encoded yet' END AS note
FROM mart_review_search m LEFT JOIN review_embeddings e ON e.comment_hash = m.comment_hash
WHERE m.topic = 'delivery' AND m.review_date >= DATE '1996-01-01'""",
    "reviews_to_enrich": """
SELECT review_id, comment FROM stg_reviews r
WHERE NOT EXISTS (SELECT 1 FROM review_enriched e WHERE e.review_id = r.review_id)""",
    "next_reviews_to_enrich": """
SELECT review_id, comment FROM stg_reviews r
WHERE NOT EXISTS (SELECT 1 FROM review_enriched e WHERE e.review_id = r.review_id) ORDER BY review_id LIMIT 5""",
    "enrich_reviews": f"""
SELECT review_id, CASE WHEN good > bad THEN 'positive' WHEN bad > good THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       {rounded("(good - bad)", "(good + bad)", 3)} AS sentiment_score, CASE {_TOPIC} ELSE 'other' END AS topic,
       CASE {_ISSUE} END AS key_issue, 'rules-1' AS model
FROM (SELECT *, {_BAD} AS bad, {_GOOD} AS good FROM rule_hits)""",
    "model_labels": f"""
SELECT review_id, CASE WHEN readable THEN (['positive', 'negative', 'neutral'])[n % 3 + 1] END AS sentiment_label,
       CASE WHEN readable THEN (n % 5 - 2) / 2.0::DOUBLE END AS sentiment_score,
       CASE WHEN readable THEN ({[*TOPICS, "weather"]})[n % 7 + 1] END AS topic,
       CASE WHEN readable AND n % 2 = 0 THEN 'length ' || n END AS key_issue, 'length' AS model,
       CASE WHEN n % 11 = 10 THEN 'TimeoutError: no reply' WHEN n % 13 = 12 THEN 'not readable'
            WHEN n % 7 = 6 THEN 'unknown topic' END AS problem
FROM (SELECT review_id, length(comment) AS n, n % 11 <> 10 AND n % 13 <> 12 AS readable FROM stg_reviews)""",
    "encode_texts": """
SELECT comment_hash, 'length' AS model, 2 AS dimension, (n / sqrt(n * n + m * m))::FLOAT::DOUBLE AS x,
       (m / sqrt(n * n + m * m))::FLOAT::DOUBLE AS y
FROM (SELECT DISTINCT comment_hash, length(comment)::DOUBLE AS n,
             (length(comment) - length(replace(comment, ' ', '')) + 1)::DOUBLE AS m FROM stg_reviews)""",
    "embed_texts": """
SELECT comment_hash, place, (n / sqrt(sum(n * n) OVER (PARTITION BY comment_hash)))::FLOAT::DOUBLE AS weight,
       'hashed-words-1' AS model, 256 AS dimensions
FROM (SELECT comment_hash, (('0x' || substr(md5(w), 1, 7))::BIGINT % 256)::INTEGER AS place, count(*)::DOUBLE AS n
      FROM (SELECT comment_hash, unnest(regexp_split_to_array(lower(trim(comment, ' ')), '\\s+')) AS w
            FROM (SELECT comment_hash, min(comment) AS comment FROM stg_reviews GROUP BY 1))
      WHERE w <> '' GROUP BY 1, 2)""",
    "review_search_results": """
SELECT comment AS text, n_reviews AS reviews, round(score, 3) AS similarity,
       string_agg(review_id::VARCHAR, ',' ORDER BY review_date DESC, review_id DESC) AS example_review_id,
       coalesce(string_agg(city, ',' ORDER BY review_date DESC, review_id DESC), '') AS example_city
FROM (SELECT * FROM search_filtered JOIN search_scored USING (comment_hash)
      QUALIFY row_number() OVER (PARTITION BY comment_hash ORDER BY review_date DESC NULLS FIRST, review_id DESC) <= 2)
GROUP BY comment_hash, comment, n_reviews, score""",
    "texts_to_embed": """
SELECT comment_hash, min(comment) AS comment FROM stg_reviews
WHERE comment_hash NOT IN (SELECT comment_hash FROM review_embeddings) GROUP BY 1""",
}

# --- profile and reports --------------------------------------------------------------------

_PROFILE = {
    "fct_orders": ["order_status", "payment_method"],
    "dim_customer": ["age_segment"],
    "dim_food": ["veg_or_non_veg"],
    "mart_review_insights": ["sentiment_label", "topic"],
}
_FEED = f"""
SELECT dt, sum(orders_on_time)::BIGINT AS orders_on_time, sum(orders_late)::BIGINT AS orders_late,
       sum(status_changes)::BIGINT AS status_changes, sum(order_items)::BIGINT AS order_items,
       sum(reviews)::BIGINT AS reviews, sum(restaurant_changes)::BIGINT AS restaurant_changes
FROM (
  SELECT f AS dt, CASE WHEN f = m AND f <= order_date THEN 1 ELSE 0 END AS orders_on_time,
         CASE WHEN f = m AND f > order_date THEN 1 ELSE 0 END AS orders_late,
         CASE WHEN f > m THEN 1 ELSE 0 END AS status_changes, 0 AS order_items, 0 AS reviews, 0 AS restaurant_changes
  FROM (SELECT order_date, {file_date()} AS f, min({file_date()}) OVER (PARTITION BY order_id) AS m FROM raw_orders)
  UNION ALL SELECT {file_date()}, 0, 0, 0, 1, 0, 0 FROM raw_order_items
  UNION ALL SELECT {file_date()}, 0, 0, 0, 0, 1, 0 FROM raw_reviews
  UNION ALL SELECT {file_date()}, 0, 0, 0, 0, 0, 1 FROM raw_restaurants)
GROUP BY 1"""

QUERIES |= {
    "latest_dates": """
SELECT (SELECT max(order_date) FROM fct_orders) AS latest_order_date,
       (SELECT max(review_date) FROM mart_daily_review_stats) AS latest_review_date""",
    "categorical_values": " UNION ALL ".join(
        f"SELECT DISTINCT '{t.upper()}.{c.upper()}' AS column_name, {c}::VARCHAR AS value FROM {t} WHERE {c} IS NOT NULL"
        for t, columns in _PROFILE.items()
        for c in columns
    ),
    "top_cities": """
SELECT city, sum(orders)::BIGINT AS orders FROM mart_daily_city_revenue GROUP BY 1
ORDER BY orders DESC, city NULLS LAST LIMIT 40""",
    "late_arrivals": f"""
SELECT order_date, orders, late_orders, {rounded("late_orders", "orders", 4)} AS late_rate
FROM (SELECT order_date, count(*) AS orders, count(*) FILTER (WHERE first_file_date > order_date) AS late_orders
      FROM first_files GROUP BY 1)""",
    "status_changes": f"""
SELECT order_id, file_day AS changed_on, from_status, order_status AS to_status
FROM (SELECT *, lag(order_status) OVER w AS from_status, row_number() OVER w AS n
      FROM (SELECT order_id, order_status, {file_date()} AS file_day FROM raw_orders
            QUALIFY row_number() OVER (PARTITION BY order_id, {file_date()}
                                       ORDER BY _loaded_at DESC NULLS LAST, order_status NULLS LAST) = 1)
      WINDOW w AS (PARTITION BY order_id ORDER BY file_day NULLS FIRST))
WHERE n > 1 AND from_status IS DISTINCT FROM order_status""",
    "amount_consistency": """
SELECT * FROM (
  SELECT o.order_id, o.subtotal, o.discount, o.delivery_fee, o.gst, o.sales_amount, l.items_total, l.wrong_lines,
         coalesce(o.subtotal <> l.items_total, false) AS bad_subtotal, coalesce(l.wrong_lines > 0, false) AS bad_lines,
         coalesce(o.gst <> round_even(o.subtotal::DOUBLE * 0.05::DOUBLE, 0), false) AS bad_gst,
         coalesce(o.sales_amount <> o.subtotal - o.discount + o.delivery_fee + o.gst, false) AS bad_sales_amount
  FROM fct_orders o
  LEFT JOIN (SELECT order_id, sum(line_amount)::DECIMAL(38,2) AS items_total,
                    count(*) FILTER (WHERE line_amount <> price * quantity) AS wrong_lines
             FROM fct_order_items GROUP BY 1) l ON l.order_id = o.order_id)
WHERE bad_subtotal OR bad_lines OR bad_gst OR bad_sales_amount""",
    # Each day against the city's other days: their pooled share or mean, and mean and deviation of their daily values
    # (in thousandths, so that sums are exact).
    "anomaly_days": f"""
SELECT a.kind, a.city, a.day, a.n, {rounded("a.total", "a.n", 4)} AS observed, {rounded("b.total", "b.n", 4)} AS baseline,
       CASE WHEN b.squares * b.days > b.v * b.v THEN round((a.v * b.days - b.v)::DOUBLE
         / sqrt((b.squares * b.days - b.v * b.v)::DOUBLE), 2) END AS deviations
FROM (SELECT *, (total * 2000 + n) // (2 * n) AS v FROM city_days) a
JOIN (SELECT x.kind, x.city, x.day, count(*) AS days, sum(y.n)::BIGINT AS n, sum(y.total)::BIGINT AS total,
             sum((y.total * 2000 + y.n) // (2 * y.n))::BIGINT AS v,
             sum(((y.total * 2000 + y.n) // (2 * y.n)) * ((y.total * 2000 + y.n) // (2 * y.n)))::BIGINT AS squares
      FROM city_days x JOIN city_days y ON y.kind = x.kind AND y.city IS NOT DISTINCT FROM x.city AND y.day <> x.day
      GROUP BY 1, 2, 3) b
  ON b.kind = a.kind AND b.city IS NOT DISTINCT FROM a.city AND b.day = a.day
WHERE a.total > 0 AND a.total * b.n * 100 >= b.total * a.n * 140""",
    "daily_feed_summary": _FEED,
    "review_eligibility": """
SELECT * FROM (
  SELECT r.review_id, r.order_id, r.review_date, o.order_date,
         CASE WHEN o.delivered IS NULL THEN 'unknown order' WHEN NOT o.delivered THEN 'not delivered'
              WHEN r.review_date <> o.order_date + 1 THEN 'not the next day' END AS reason
  FROM stg_reviews r LEFT JOIN (SELECT order_id, min(order_date) AS order_date, bool_or(order_status = 'Delivered') AS delivered
                                FROM raw_orders GROUP BY 1) o ON o.order_id = r.order_id)
WHERE reason IS NOT NULL""",
}

# --- checks ---------------------------------------------------------------------------------


def _unique(label: str, table: str, key: str) -> str:
    failing = f"SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return f"SELECT 'unique {label}.{key}' AS check_name, 'error' AS severity, (SELECT count(*) FROM ({failing})) AS failures"


def _not_null(label: str, table: str, column: str, severity: str = "error") -> str:
    return (
        f"SELECT 'not_null {label}.{column}' AS check_name, '{severity}' AS severity, "
        f"(SELECT count(*) FROM {table} WHERE {column} IS NULL) AS failures"
    )


def _same(kind, table: str, column: str) -> str:
    return kind(table, table, column)


_HISTORY = "dim_restaurants_history", "restaurants_history"
_CHECKS = [
    *[_same(_unique, t, k) for t, k in (("stg_orders", "order_id"), ("stg_order_items", "order_item_id"),
      ("stg_restaurants", "restaurant_id"), ("stg_users", "customer_id"), ("stg_reviews", "review_id"),
      ("fct_orders", "order_id"), ("mart_review_search", "review_id"))],
    _unique(*_HISTORY, "restaurant_version_key"),
    *[_same(_not_null, t, c) for t, c in (("stg_orders", "order_id"), ("stg_orders", "customer_id"),
      ("stg_orders", "restaurant_id"), ("stg_orders", "_loaded_at"), ("stg_order_items", "order_item_id"),
      ("stg_restaurants", "restaurant_id"), ("stg_users", "customer_id"), ("stg_reviews", "review_id"),
      ("fct_orders", "order_id"), ("mart_review_search", "review_id"), ("mart_review_search", "comment_hash"))],
    _not_null(*_HISTORY, "restaurant_version_key"),
    _not_null(*_HISTORY, "valid_from"),
    _not_null("fct_orders_point_in_time", "fct_orders_point_in_time", "restaurant_version_key", "warn"),
    """SELECT 'relationships fct_orders.customer_id', 'error', (SELECT count(DISTINCT customer_id) FROM fct_orders
       WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer))""",
    """SELECT 'accepted_values fct_orders.order_status', 'error', (SELECT count(DISTINCT order_status) FROM fct_orders
       WHERE order_status NOT IN ('Delivered', 'Cancelled', 'Refunded'))""",
]


def _drift(sides: dict[str, str], measures: dict[str, str]) -> str:
    """One row with the totals of both sides when a measure differs."""
    totals = ", ".join(f"{sql} AS {m}" for m, sql in measures.items())
    both = " UNION ALL ".join(f"SELECT '{side}' AS side, {totals} FROM {rows}" for side, rows in sides.items())
    pivot = ", ".join(f"max({m}) FILTER (WHERE side = '{side}') AS {side}_{m}" for m in measures for side in sides)
    differs = " OR ".join(f"min({m}) <> max({m}) OR count({m}) = 1" for m in measures)
    return f"SELECT {pivot} FROM ({both}) HAVING {differs}"


_ORDER_TOTALS = {
    "orders": "count(*)",
    "delivered_gmv": "coalesce(sum(sales_amount) FILTER (WHERE order_status = 'Delivered'), 0)::BIGINT",
    "refunded": "count(*) FILTER (WHERE order_status = 'Refunded')",
}
_ITEM_TOTALS = {"items": "count(*)", "amount": "sum(line_amount)::DECIMAL(20,2)"}


QUERIES |= {
    "dq_unique": """
SELECT order_item_id, count(*) AS n FROM raw_order_items WHERE order_item_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_not_null": "SELECT * FROM fct_orders_point_in_time WHERE restaurant_version_key IS NULL",
    "dq_relationships": """
SELECT customer_id, count(*) AS n FROM fct_orders
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM dim_customer) GROUP BY 1""",
    "dq_accepted_values": """
SELECT veg_or_non_veg, count(*) AS n FROM raw_food WHERE veg_or_non_veg NOT IN ('Veg', 'Non-veg') GROUP BY 1""",
    "dq_report": "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ("
    + "\nUNION ALL ".join(_CHECKS)
    + ")",
    "reconcile_orders": _drift({"raw": "stg_orders", "fct": "fct_orders"}, _ORDER_TOTALS),
    "reconcile_orders_without_late": _drift({"raw": "stg_orders", "fct": "on_time_orders"}, _ORDER_TOTALS),
    "reconcile_order_items": _drift({"raw": "raw_items_of_orders", "fct": "fct_order_items"}, _ITEM_TOTALS),
    "reconcile_items_without_late": _drift(
        {"raw": "raw_items_of_orders", "fct": "stg_order_items WHERE order_id IN (SELECT order_id FROM on_time_orders)"},
        _ITEM_TOTALS,
    ),
    "history_current_broken": """
SELECT restaurant_id, sum(is_current::INTEGER)::BIGINT AS current_versions
FROM (SELECT restaurant_id, CASE WHEN restaurant_id % 3 = 0 THEN false WHEN restaurant_id % 3 = 1 THEN true ELSE is_current END AS is_current
      FROM restaurants_history)
GROUP BY restaurant_id HAVING sum(is_current::INTEGER) <> 1
UNION ALL
SELECT NULL, count(*) FROM stg_restaurants WHERE restaurant_id % 7 = 0 HAVING count(*) > 0""",
    "assert_history_current": """
SELECT restaurant_id, sum(is_current::INTEGER)::BIGINT AS current_versions FROM restaurants_history
GROUP BY restaurant_id HAVING sum(is_current::INTEGER) <> 1
UNION ALL
SELECT NULL, abs(gap) FROM (SELECT count(DISTINCT h.restaurant_id) - count(DISTINCT s.restaurant_id) AS gap
                            FROM restaurants_history h FULL JOIN stg_restaurants s ON s.restaurant_id = h.restaurant_id)
WHERE gap <> 0""",
}

# What follows changes equals what is computed from all rows.
QUERIES |= {
    "performance_from_changes": QUERIES["mart_restaurant_performance"],
    "delivery_sla_from_counts": QUERIES["mart_delivery_sla"],
    "price_changes_from_changes": QUERIES["mart_restaurant_price_changes"],
    "reconcile_from_ledger": f"SELECT *, true AS rows_differ FROM ({QUERIES['reconcile_orders_without_late']})",
}

_LOWERED = "translate(comment, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ANCHORS = "(VALUES ('food quality', ['the', 'and'], 1), ('delivery', ['der', 'und'], 2), ('pricing', ['les', 'des'], 3), ('service', ['que', 'los'], 4)) AS a(topic, named, place)"
QUERIES["learned_labels"] = rf"""
SELECT review_id, round(raw, 6) AS raw, key_issue, coalesce(topic, 'other') AS topic FROM (
WITH r AS (SELECT review_id, rating, list_distinct(regexp_extract_all({_LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS words FROM stg_reviews),
     w AS (SELECT review_id, rating, unnest(words) AS word FROM r),
     c AS (SELECT word, count(*) FILTER (rating >= 4) AS up, count(*) FILTER (rating <= 2) AS down
           FROM w WHERE rating >= 4 OR rating <= 2 GROUP BY word),
     t AS (SELECT sum(up)::DOUBLE AS all_up, sum(down)::DOUBLE AS all_down FROM c),
     p AS (SELECT word, up + prior AS u, down + prior AS d, all_up, all_down
           FROM (SELECT *, 100::DOUBLE * (up + down) / (all_up + all_down) AS prior FROM c, t)),
     o AS (SELECT word, ln(u / (all_up + 100 - u)) - ln(d / (all_down + 100 - d)) AS weight, sqrt(1 / u + 1 / d) AS error FROM p),
     weights AS (SELECT word, weight FROM o WHERE abs(weight) >= 1.96::DOUBLE * error),
     scores AS (SELECT review_id, sum(weight) AS raw, arg_min(word, struct_pack(weight := weight, word := word)) FILTER (weight < 0) AS key_issue
                FROM w JOIN weights USING (word) GROUP BY review_id),
     of_topic AS (SELECT review_id, topic, place FROM r, {_ANCHORS} WHERE list_has_any(words, named)),
     sizes AS (SELECT topic, count(*) AS n FROM of_topic GROUP BY topic),
     seen AS (SELECT word, count(*) AS n FROM w GROUP BY word),
     together AS (SELECT word, topic, place, count(*) AS n FROM w JOIN of_topic USING (review_id) GROUP BY ALL HAVING count(*) >= 5),
     affinities AS (SELECT word, topic, place, ln(together.n * (SELECT count(*) FROM r) / (seen.n * sizes.n::DOUBLE)) AS affinity
                    FROM together JOIN seen USING (word) JOIN sizes USING (topic)),
     sums AS (SELECT review_id, topic, place, sum(affinity) AS affinity FROM w JOIN affinities USING (word) WHERE affinity > 0 GROUP BY ALL),
     topics AS (SELECT review_id, arg_max(topic, struct_pack(a := round(affinity, 9), p := -place)) AS topic FROM sums GROUP BY review_id)
SELECT r.review_id, raw, key_issue, topic FROM r LEFT JOIN scores USING (review_id) LEFT JOIN topics USING (review_id))"""
