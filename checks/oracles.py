"""The same queries in SQL, over views named like the test tables."""

from __future__ import annotations

import re

PLACES = """
places AS (
  SELECT n_nationkey, n_name AS city, r_name AS province
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

ITEMS = """
items AS (
  SELECT order_id, product_id, price, quantity, price AS item_total
  FROM (
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
           CAST(l_quantity AS INTEGER) AS quantity,
           row_number() OVER (PARTITION BY l_orderkey, l_partkey
                              ORDER BY l_extendedprice, l_quantity) AS copy
    FROM lineitem
  ) WHERE copy = 1
)"""

CUSTOMERS = f"""{PLACES},
customers AS (
  SELECT c_custkey AS customer_id, CAST(NULL AS VARCHAR) AS postal_code, city, province
  FROM customer LEFT JOIN places ON c_nationkey = n_nationkey
)"""

# Amounts have two decimals in the test tables, so sums of DECIMAL(18,2) are exact.
TOTALS = f"""{ITEMS},
totals AS (
  SELECT o_custkey AS customer_id,
         count(*) AS n_transactions,
         CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
         CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_spend,
         count(DISTINCT product_id) AS n_distinct_products,
         count(DISTINCT order_id) AS n_orders
  FROM orders JOIN items ON o_orderkey = order_id
  GROUP BY o_custkey
),
latest AS (
  SELECT o_custkey AS customer_id, max(o_orderdate) AS last_purchase FROM orders GROUP BY o_custkey
),
customer_totals AS (
  SELECT totals.*, total_spend AS spend_value, last_purchase
  FROM totals LEFT JOIN latest USING (customer_id)
)"""


def _tiers(customer_id: str = "customer_id") -> str:
    return f"""{TOTALS},
ranked AS (
  SELECT *, CAST(ntile(4) OVER (ORDER BY spend_value DESC, {customer_id}) AS INTEGER) AS segment
  FROM customer_totals
),
tiers AS (
  SELECT *, CASE segment WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver'
                         ELSE 'Bronze' END AS tier
  FROM ranked
)"""


def _customer_metrics(as_text: bool) -> str:
    key = "CAST(customer_id AS VARCHAR)" if as_text else "customer_id"
    postal_code = "'00000'" if as_text else "postal_code"
    market = ", c_mktsegment AS market" if as_text else ""
    markets = "LEFT JOIN customer ON customer_id = c_custkey" if as_text else ""
    return f"""WITH {CUSTOMERS}, {_tiers(key)}
SELECT {key} AS customer_id, n_transactions, total_spend, avg_spend, n_distinct_products,
       n_orders, spend_value, last_purchase, {postal_code} AS postal_code, city, province,
       segment AS tier_no, tier{market}
FROM tiers LEFT JOIN customers USING (customer_id) {markets}"""


def _product_metrics(as_text: bool) -> str:
    key = "CAST(product_id AS VARCHAR)" if as_text else "product_id"
    brand = ", p_brand AS brand" if as_text else ""
    return f"""WITH {ITEMS},
sold AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
         CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
         CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price
  FROM items GROUP BY product_id
)
SELECT {key} AS product_id, units_sold, total_sales, avg_price, p_retailprice AS price,
       p_type AS category,
       CAST(row_number() OVER (PARTITION BY p_type ORDER BY units_sold DESC, {key}) AS INTEGER)
         AS rank_in_category{brand}
FROM sold LEFT JOIN part ON product_id = p_partkey"""


def _region(*columns: str) -> str:
    region = ", ".join(columns)
    cents = "sum(CAST(round(spend_value * 100) AS HUGEINT))"
    return f"""WITH {CUSTOMERS}, {TOTALS}
SELECT {region}, count(*) AS n_customers,
       CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
       CAST((2 * {cents} + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_spend
FROM customer_totals JOIN customers USING (customer_id)
GROUP BY {region}"""


def _completed(as_text: bool) -> str:
    def key(name: str) -> str:
        return f"CAST({name} AS VARCHAR)" if as_text else name

    return f"""WITH {CUSTOMERS}, {ITEMS}
SELECT {key('order_id')} AS order_id, {key('product_id')} AS product_id,
       {key('o_custkey')} AS customer_id, province, price, o_totalprice AS total_payment,
       p_type AS category, o_orderstatus AS order_status, o_orderdate AS purchased_at
FROM items JOIN orders ON order_id = o_orderkey
LEFT JOIN customers ON customer_id = o_custkey
LEFT JOIN part ON product_id = p_partkey
WHERE price > 0 AND o_orderstatus = 'F'"""


_GOLD = """
done AS (
  SELECT o_custkey AS customer_id, order_id, price, o_totalprice, o_orderdate
  FROM items JOIN orders ON order_id = o_orderkey
  WHERE price > 0 AND o_orderstatus = 'F'
),
paid AS (
  SELECT customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_payment
  FROM (SELECT DISTINCT customer_id, order_id, o_totalprice FROM done)
  GROUP BY customer_id
),
measures AS (
  SELECT customer_id, province,
         CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_price,
         CAST(count(DISTINCT order_id) AS INTEGER) AS n_orders,
         max(o_orderdate) AS last_purchase
  FROM done LEFT JOIN customers USING (customer_id)
  GROUP BY customer_id, province
),
gold AS (
  SELECT tiers.customer_id, segment, avg_price, measures.n_orders AS n_orders,
         measures.last_purchase AS last_purchase, province, total_payment
  FROM tiers LEFT JOIN measures ON tiers.customer_id = measures.customer_id
             LEFT JOIN paid ON tiers.customer_id = paid.customer_id
)"""

GOLD = f"{CUSTOMERS}, {_tiers()}, {_GOLD}"


def _gold_by_text_key() -> str:
    """Tiers of equal spend go by customer id, which is text in the lake."""
    return f"{CUSTOMERS}, {_tiers('CAST(customer_id AS VARCHAR)')}, {_GOLD}"


AVERAGES = """round(avg(n_transactions), 4) AS avg_n_transactions,
       round(avg(total_spend), 4) AS avg_total_spend,
       round(avg(avg_spend), 4) AS avg_avg_spend,
       round(avg(n_distinct_products), 4) AS avg_n_distinct_products"""

FEATURES = ("n_transactions", "total_spend", "avg_spend", "n_distinct_products")


def _scaled(digits: int | None) -> str:
    parts = []
    for f in FEATURES:
        value = f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER ()"
        parts.append(f"{f'round({value}, {digits}) + 0.0' if digits else value} AS scaled_{f}")
    return ", ".join(parts)


def _silhouette_of(points: str) -> str:
    """Mean silhouette on squared Euclidean distance of a table of scaled points with segments.

    The mean squared distance of a point to a cluster is |x|^2 + mean|y|^2 - 2 x . mean(y).
    """
    scaled = [f"scaled_{f}" for f in FEATURES]
    norm = " + ".join(f"{s} * {s}" for s in scaled)
    sums = ", ".join(f"avg({s}) AS m_{s}" for s in scaled)
    dot = " + ".join(f"{s} * m_{s}" for s in scaled)
    return f"""normed AS (SELECT *, {norm} AS norm FROM {points}),
clusters AS (
  SELECT segment AS other, count(*) AS n, avg(norm) AS m_norm, {sums} FROM normed GROUP BY segment
),
distances AS (
  SELECT customer_id, segment, other, n, norm + m_norm - 2 * ({dot}) AS d
  FROM normed CROSS JOIN clusters
),
sides AS (
  SELECT customer_id,
         max(CASE WHEN other = segment THEN d * n / (n - 1) END) AS a,
         min(CASE WHEN other <> segment THEN d END) AS b
  FROM distances GROUP BY customer_id
)
SELECT count(*) AS n_customers, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM sides"""


def _two_means(rounds: int = 40) -> str:
    """K-Means with two clusters, written out as rounds of assigning and averaging.

    It starts from the halves by spend and goes on until no centre moves; on the test tables that
    is the fixed point which Spark reaches too. Segment 0 spends more.
    """
    scaled = [f"scaled_{f}" for f in FEATURES]

    def distance(side: str) -> str:
        return " + ".join(f"(p.{s} - c.{side}_{s}) * (p.{s} - c.{side}_{s})" for s in scaled)

    def means(side: str, label: int) -> str:
        return ", ".join(
            f"avg(CASE WHEN label = {label} THEN {s} END) AS {side}_{s}" for s in scaled
        )

    parts = [
        f"""{TOTALS},
points AS MATERIALIZED (
  SELECT *, {_scaled(None)} FROM customer_totals
),
halves AS (
  SELECT *, ntile(2) OVER (ORDER BY total_spend DESC, customer_id) - 1 AS label
  FROM points
),
centers0 AS MATERIALIZED (SELECT {means('a', 0)}, {means('b', 1)} FROM halves)"""
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""centers{i} AS MATERIALIZED (
  SELECT {means('a', 0)}, {means('b', 1)}
  FROM (SELECT p.*, CASE WHEN {distance('a')} <= {distance('b')} THEN 0 ELSE 1 END AS label
        FROM points p, centers{i - 1} c)
)"""
        )
    parts.append(
        f"""members AS MATERIALIZED (
  SELECT p.*, CAST(CASE WHEN ({distance('a')} <= {distance('b')})
                             = (c.a_scaled_total_spend >= c.b_scaled_total_spend)
                        THEN 0 ELSE 1 END AS INTEGER) AS segment
  FROM points p, centers{rounds} c
)"""
    )
    return ",\n".join(parts)


TEXT_ITEMS = """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id,
       price, quantity, item_total
FROM items"""

SELLERS = f"""WITH {PLACES}
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, city, province
FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey"""

# The star tables after the second batch of the refresh: in the last month orders with a number
# divisible by three are gone and prices have doubled.
_CHANGED = """
last_month AS (SELECT strftime(max(o_orderdate), '%Y-%m') AS month FROM orders),
new_orders AS (
  SELECT orders.* FROM orders, last_month
  WHERE strftime(o_orderdate, '%Y-%m') <> month OR o_orderkey % 3 <> 0
),
new_lines AS (
  SELECT l_orderkey, l_partkey, l_quantity,
         CASE WHEN strftime(o_orderdate, '%Y-%m') = month THEN 2 * l_extendedprice
              ELSE l_extendedprice END AS l_extendedprice
  FROM lineitem JOIN new_orders ON l_orderkey = o_orderkey, last_month
)"""


def _after_refresh(sql: str) -> str:
    """The SQL of a full run over the changed tables."""
    changed = re.sub(r"\borders\b", "new_orders", re.sub(r"\blineitem\b", "new_lines", sql))
    return changed.replace("WITH ", f"WITH {_CHANGED},", 1)


_RAW_ITEMS = """
raw_items AS (
  SELECT CASE WHEN l_orderkey % 17 <> 0 THEN l_orderkey END AS order_id, l_partkey AS product_id,
         CASE WHEN l_orderkey % 13 <> 0 THEN l_extendedprice END AS price,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS item_total,
         concat_ws(', ', CASE WHEN l_orderkey % 17 = 0 THEN 'null key' END,
                   CASE WHEN l_orderkey % 13 = 0 THEN 'malformed price' END) AS problems
  FROM lineitem
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                               ORDER BY price NULLS LAST, quantity, item_total) AS place
  FROM raw_items
)"""

ORACLES = {
    "clean_customers": f"""WITH {CUSTOMERS}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, '00000' AS postal_code, city, province
FROM customers""",
    "clean_products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_retailprice AS price, p_type AS category
FROM part""",
    "clean_transactions": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_totalprice AS total_payment, CAST(NULL AS INTEGER) AS installments,
       o_orderdate AS purchased_at, CAST(NULL AS TIMESTAMP) AS approved_at,
       CAST(NULL AS TIMESTAMP) AS shipped_at, CAST(NULL AS DATE) AS estimated_arrival,
       o_orderstatus AS order_status
FROM orders""",
    "clean_order_items": f"WITH {ITEMS} {TEXT_ITEMS}",
    "clean_reviews": """
SELECT customer_id, product_id, rating, review_date
FROM (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS product_id,
         CAST(value AS FLOAT) AS rating, CAST(ts AS DATE) AS review_date,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY CAST(value AS FLOAT), CAST(ts AS DATE)) AS copy
  FROM events
) WHERE copy = 1""",
    "rejected_values": """
SELECT 'products' AS table_name, 'price' AS column_name,
       (SELECT count(p_retailprice) FROM part) + (SELECT count(c_name) FROM customer) AS n_values,
       (SELECT count(*) FROM customer WHERE TRY_CAST(c_name AS DOUBLE) IS NULL) AS n_rejected""",
    "sellers": SELLERS,
    "transaction_items": f"""WITH {ITEMS}
SELECT order_id, o_custkey AS customer_id, o_totalprice AS total_payment,
       o_orderdate AS purchased_at, o_orderstatus AS order_status,
       product_id, price, quantity, item_total
FROM orders JOIN items ON o_orderkey = order_id""",
    "order_totals": f"""WITH {ITEMS}
SELECT order_id, count(*) AS n_rows, count(product_id) AS n_items,
       CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) AS items_sum,
       count(item_total) AS items_counted,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price_sum,
       count(price) AS prices_counted,
       CAST(sum(CASE WHEN price > 0 THEN CAST(price AS DECIMAL(18,2)) END) AS DOUBLE) AS paid_sum,
       count(CASE WHEN price > 0 THEN 1 END) AS n_paid
FROM items GROUP BY order_id""",
    "transaction_metrics": f"""WITH {ITEMS}
SELECT order_id, o_custkey AS customer_id, o_orderdate AS purchased_at,
       CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) AS order_total,
       count(product_id) AS n_items,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_item_price,
       strftime(o_orderdate, '%Y-%m-%d') AS purchase_day,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week
FROM orders JOIN items ON o_orderkey = order_id
GROUP BY order_id, o_custkey, o_orderdate""",
    "latest_purchase": """
SELECT o_custkey AS customer_id, max(o_orderdate) AS last_purchase FROM orders GROUP BY o_custkey""",
    "customer_metrics": _customer_metrics(as_text=False),
    "product_metrics": _product_metrics(as_text=False),
    "province_metrics": _region("province"),
    "city_metrics": _region("province", "city"),
    "completed_orders": _completed(as_text=False),
    "tier_counts": f"""WITH {_tiers()}
SELECT tier, count(*) AS n_customers FROM tiers GROUP BY tier""",
    "tier_averages": f"""WITH {_tiers()}
SELECT segment, {AVERAGES} FROM tiers GROUP BY segment""",
    "tier_profile": f"""WITH {_tiers()}
SELECT segment, count(DISTINCT customer_id) AS n_customers, {AVERAGES}
FROM tiers GROUP BY segment""",
    "top_customers_tier1": f"""WITH {_tiers()}
SELECT customer_id, total_spend, segment FROM tiers WHERE segment = 1
ORDER BY total_spend DESC, customer_id LIMIT 5""",
    "top_customers_per_tier": f"""WITH {_tiers()},
placed AS (
  SELECT customer_id, total_spend, segment,
         CAST(row_number() OVER (PARTITION BY segment ORDER BY total_spend DESC, customer_id)
              AS INTEGER) AS place
  FROM tiers
)
SELECT * FROM placed WHERE place <= 5""",
    "gold_segments": f"WITH {GOLD} SELECT * FROM gold",
    "spend_by_province_tier": f"""WITH {GOLD}
SELECT province, segment,
       CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) AS total_purchases
FROM gold GROUP BY province, segment""",
    "scaled_features": f"WITH {TOTALS} SELECT customer_id, {_scaled(6)} FROM customer_totals",
    "tier_silhouette": f"""WITH {_tiers()},
points AS (SELECT customer_id, segment, {_scaled(None)} FROM tiers),
{_silhouette_of('points')}""",
    "kmeans_control_totals": f"""WITH {TOTALS}
SELECT count(*) AS n_customers, count(DISTINCT customer_id) AS n_distinct_customers,
       CAST(sum(n_transactions) AS BIGINT) AS n_transactions,
       CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS total_spend
FROM customer_totals""",
    "two_means_segments": f"""WITH {_two_means()}
SELECT customer_id, n_transactions, total_spend, avg_spend, n_distinct_products, segment
FROM members""",
    "two_means_profile": f"""WITH {_two_means()}
SELECT segment, count(DISTINCT customer_id) AS n_customers, {AVERAGES}
FROM members GROUP BY segment""",
    "two_means_centers": f"""WITH {_two_means()}
"""
    + " UNION ALL ".join(
        f"""SELECT segment, '{f}' AS feature, round(avg(scaled_{f}), 6) + 0.0 AS scaled_center,
       round(avg({f}), 4) AS center
FROM members GROUP BY segment"""
        for f in FEATURES
    ),
    "two_means_gold_segments": f"""WITH {_two_means()},
gold_tiers AS (
  WITH {GOLD} SELECT * FROM gold
)
SELECT members.customer_id, members.segment, avg_price, gold_tiers.n_orders AS n_orders,
       gold_tiers.last_purchase AS last_purchase, province,
       total_payment
FROM members JOIN gold_tiers ON members.customer_id = gold_tiers.customer_id""",
    "two_means_silhouette": f"""WITH {_two_means()},
{_silhouette_of('members')}""",
    "kmeans_fixed_points": """
SELECT CAST(k AS INTEGER) AS k, CAST(0 AS BIGINT) AS n_misplaced, true AS centers_are_means
FROM range(2, 9) AS t(k)""",
    "lake_bronze_sellers": SELLERS,
    "lake_silver_order_items": f"WITH {ITEMS} {TEXT_ITEMS}",
    "lake_completed_orders": _completed(as_text=True),
    "lake_customer_metrics": _customer_metrics(as_text=True),
    "lake_product_metrics": _product_metrics(as_text=True),
    "lake_city_metrics": _region("province", "city"),
    "lake_segment_table": f"""WITH {_tiers('CAST(customer_id AS VARCHAR)')}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, n_transactions, total_spend, avg_spend,
       n_distinct_products, segment
FROM tiers""",
    "catalog_overview": f"""WITH {CUSTOMERS}, {TOTALS},
known AS (SELECT * FROM customer_totals JOIN customers USING (customer_id))
SELECT 'transaction_metrics' AS table_name, count(DISTINCT order_id) AS n_rows,
       'struct<order_id:string,customer_id:string,purchased_at:timestamp,order_total:double,'
       || 'n_items:bigint,avg_item_price:double,purchase_day:string,month:int,year:int,'
       || 'day_of_week:int>' AS schema
FROM items JOIN orders ON order_id = o_orderkey
UNION ALL SELECT 'customer_metrics', count(*),
       'struct<customer_id:string,n_transactions:bigint,total_spend:double,avg_spend:double,'
       || 'n_distinct_products:bigint,n_orders:bigint,spend_value:double,last_purchase:timestamp,'
       || 'postal_code:string,city:string,province:string,tier_no:int,tier:string,market:string>'
FROM customer_totals
UNION ALL SELECT 'product_metrics', count(DISTINCT product_id),
       'struct<product_id:string,units_sold:bigint,total_sales:double,avg_price:double,'
       || 'price:double,category:string,rank_in_category:int,brand:string>'
FROM items
UNION ALL SELECT 'province_metrics', count(DISTINCT province),
       'struct<province:string,n_customers:bigint,total_spend:double,avg_spend:double>'
FROM known
UNION ALL SELECT 'city_metrics', count(*),
       'struct<province:string,city:string,n_customers:bigint,total_spend:double,'
       || 'avg_spend:double>'
FROM (SELECT DISTINCT province, city FROM known)""",
    "lake_silver_customers": f"""WITH {CUSTOMERS}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, '00000' AS postal_code, city, province,
       c_mktsegment AS market
FROM customers JOIN customer ON customer_id = c_custkey""",
    "lake_load_counts": """
WITH found(table_name, problem, n_checked) AS (
  SELECT t, unnest(['broken record', 'null key']), n
  FROM (SELECT 'customers' AS t, count(*) AS n FROM customer
        UNION ALL SELECT 'products', count(*) FROM part
        UNION ALL SELECT 'transactions', count(*) FROM orders
        UNION ALL SELECT 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'reviews', count(*) FROM events)
  UNION ALL SELECT 'sellers', 'broken record', count(*) FROM supplier
  UNION ALL SELECT 'products', 'malformed price', count(p_retailprice) FROM part
  UNION ALL SELECT 'transactions', 'malformed total_payment', count(o_totalprice) FROM orders
  UNION ALL SELECT 'transactions', unnest(['malformed installments', 'malformed approved_at',
                                           'malformed shipped_at', 'malformed estimated_arrival']),
                   0
  UNION ALL SELECT 'transactions', 'malformed purchased_at', count(o_orderdate) FROM orders
  UNION ALL SELECT 'order_items', 'malformed price', count(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'order_items', 'malformed quantity', count(l_quantity) FROM lineitem
  UNION ALL SELECT 'order_items', 'malformed item_total', count(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'reviews', 'malformed rating', count(value) FROM events
  UNION ALL SELECT 'reviews', 'malformed review_date', count(ts) FROM events
)
SELECT table_name, problem, CAST(n_checked AS BIGINT) AS n_checked, CAST(0 AS BIGINT) AS n_found
FROM found""",
    "broken_records": """
SELECT 'sellers' AS table_name, 'broken record' AS problem, count(*) AS n_checked,
       count(CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 THEN 1 END) AS n_found,
       CAST(count(*) AS INTEGER) AS n_loaded
FROM supplier""",
    "flat_orders": f"""WITH {CUSTOMERS}, {ITEMS}
SELECT order_id, product_id, o_custkey AS customer_id, province, price,
       o_totalprice AS total_payment, p_type AS category, o_orderstatus AS order_status,
       o_orderdate AS purchased_at
FROM items JOIN orders ON order_id = o_orderkey
LEFT JOIN customers ON customer_id = o_custkey
LEFT JOIN part ON product_id = p_partkey""",
    "lake_flat_order_view": f"""WITH {CUSTOMERS}, {ITEMS}
SELECT province AS provinsi_pelanggan, o_orderstatus AS status_order, count(*) AS n_rows,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS harga
FROM items JOIN orders ON order_id = o_orderkey
LEFT JOIN customers ON customer_id = o_custkey
GROUP BY province, o_orderstatus""",
    "source_view_spend": f"""WITH {_gold_by_text_key()}
SELECT province AS provinsi_pelanggan, segment,
       CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) AS total_pembelian
FROM gold GROUP BY province, segment""",
    "source_view_counts": f"""WITH {_gold_by_text_key()}
SELECT segment, count(*) AS jumlah_pelanggan FROM gold GROUP BY segment""",
    "fine_order_sums": f"""WITH {ITEMS}
SELECT order_id, round(sum(price / 7e10), 12) AS price_sum FROM items GROUP BY order_id""",
    "layer_gates": f"""WITH {ITEMS},
counts AS (
  SELECT 'bronze' AS layer, 'customers' AS table_name, count(*) AS n_rows, count(*) AS n_keys
  FROM customer
  UNION ALL SELECT 'bronze', 'order_items', (SELECT count(*) FROM lineitem), count(*) FROM items
  UNION ALL SELECT 'silver', 'customers', count(*), count(*) FROM customer
  UNION ALL SELECT 'silver', 'products', count(*), count(*) FROM part
  UNION ALL SELECT 'silver', 'transactions', count(*), count(*) FROM orders
  UNION ALL SELECT 'silver', 'order_items', count(*), count(*) FROM items
  UNION ALL SELECT 'silver', 'reviews', count(*), count(*)
            FROM (SELECT DISTINCT user_id, event_type FROM events)
  UNION ALL SELECT 'silver', 'sellers', count(*), count(*) FROM supplier
)
SELECT table_name, n_rows, n_keys, '' AS missing_columns, n_rows = n_keys AS ready, layer
FROM counts""",
    "region_metrics": " UNION ALL ".join(
        f"SELECT 'province' AS level, province, {city} AS city, n_customers, total_spend, avg_spend "
        f"FROM ({_region('province')})"
        if level == "province"
        else "SELECT 'city', province, city, n_customers, total_spend, avg_spend "
        f"FROM ({_region('province', 'city')})"
        for level, city in (("province", "CAST(NULL AS VARCHAR)"), ("city", "city"))
    ),
    "refreshed_customer_metrics": _after_refresh(
        f"""WITH {CUSTOMERS}, {_tiers("CAST(customer_id AS VARCHAR)")}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, n_transactions, total_spend, avg_spend,
       n_distinct_products, n_orders, spend_value, last_purchase, '00000' AS postal_code, city,
       province, segment AS tier_no, tier
FROM tiers LEFT JOIN customers USING (customer_id)"""
    ),
    "refreshed_product_metrics": _after_refresh(
        f"SELECT * EXCLUDE (brand) FROM ({_product_metrics(as_text=True)})"
    ),
    "refreshed_city_metrics": _after_refresh(_region("province", "city")),
    "refreshed_transactions": _after_refresh(f"""WITH {ITEMS}
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderdate AS purchased_at,
       CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE) AS order_total,
       count(product_id) AS n_items,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS avg_item_price,
       strftime(o_orderdate, '%Y-%m-%d') AS purchase_day,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
       strftime(o_orderdate, '%Y-%m') AS period
FROM orders JOIN items ON o_orderkey = order_id
GROUP BY order_id, o_custkey, o_orderdate"""),
    "lake_two_months": f"""WITH {ITEMS}
SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderstatus AS order_status,
       count(*) AS n_items, count(DISTINCT order_id) AS n_orders,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM items JOIN orders ON o_orderkey = order_id
WHERE strftime(o_orderdate, '%Y-%m') IN ('1995-01', '1995-02')
GROUP BY ALL""",
    "lake_quarter_items": f"""WITH {ITEMS},
first_days AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(min(o_orderdate) AS DATE) AS first_day
  FROM orders GROUP BY ALL
)
SELECT '1996-Q3' AS quarter, period, first_day, count(*) AS n_items,
       CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM items JOIN orders ON o_orderkey = order_id
JOIN first_days ON period = strftime(o_orderdate, '%Y-%m')
WHERE period IN ('1996-07', '1996-08', '1996-09')
GROUP BY ALL""",
    "bucketed_customer_totals": f"""WITH {TOTALS}
SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM customer_totals""",
    "bucketed_completed_orders": _completed(as_text=True),
    "quarantined_items": f"""WITH {_RAW_ITEMS}
SELECT 'order_items' AS table_name,
       concat_ws(', ', CASE WHEN problems <> '' THEN problems END,
                 CASE WHEN place > 1 THEN 'dropped copy' END) AS problems,
       place > 1 AS dropped, count(*) AS n_rows
FROM placed WHERE problems <> '' OR place > 1
GROUP BY ALL""",
    "quarantine_balance": f"""WITH {ITEMS},
counts AS (
  SELECT 'customers' AS table_name, count(*) AS n_raw, count(*) AS n_silver FROM customer
  UNION ALL SELECT 'products', count(*), count(*) FROM part
  UNION ALL SELECT 'transactions', count(*), count(*) FROM orders
  UNION ALL SELECT 'order_items', (SELECT count(*) FROM lineitem), count(*) FROM items
  UNION ALL SELECT 'reviews', (SELECT count(*) FROM events), count(*)
            FROM (SELECT DISTINCT user_id, event_type FROM events)
  UNION ALL SELECT 'sellers', count(*), count(*) FROM supplier
)
SELECT *, n_raw - n_silver AS n_dropped, true AS balanced FROM counts""",
    "full_gates": f"""WITH {ITEMS},
n AS (SELECT count(*) AS n, count(CASE WHEN order_id % 10 = 0 THEN 1 END) AS lost FROM items),
c AS (SELECT count(*) AS n FROM customer)
SELECT 'orphaned' AS place, 'order_items' AS table_name, 'orphans' AS state, n AS n_rows,
       n AS n_keys, '' AS missing_columns, '' AS wrong_types, lost AS n_orphans, false AS ready
FROM n
UNION ALL SELECT 'good', 'order_items', 'ready', n, n, '', '', 0, true FROM n
UNION ALL SELECT 'retyped', 'order_items', 'wrong types', n, n, '', 'price:string', 0, false FROM n
UNION ALL SELECT 'cut', 'order_items', 'wrong columns', n, n, 'price,quantity', '', 0, false FROM n
UNION ALL SELECT 'empty', 'order_items', 'empty', 0, 0, '', '', 0, false
UNION ALL SELECT 'repeated', 'customers', 'repeated keys', 2 * n, n, '', '', 0, false FROM c
UNION ALL SELECT 'absent', 'reviews', 'absent', NULL, NULL, NULL, NULL, NULL, false
UNION ALL SELECT 'unreadable', 'reviews', 'unreadable', NULL, NULL, NULL, NULL, NULL, false""",
    "spend_chart_by_tier": f"""WITH {GOLD},
spent AS (
  SELECT province, segment, CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) AS s
  FROM gold GROUP BY province, segment
)
SELECT province, """
    + ", ".join(
        f"coalesce(max(CASE WHEN segment = {s} THEN s END), 0.0)::DOUBLE AS segment_{s}"
        for s in (1, 2, 3, 4, 9)
    )
    + """
FROM spent GROUP BY province""",
    "customer_recency": """
SELECT c_custkey AS customer_id,
       CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '1998-12-31') AS INTEGER)
         AS recency_days
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "recency_features": f"""WITH {TOTALS},
rated AS (
  SELECT customer_id, total_spend,
         date_diff('day', CAST(last_purchase AS DATE), DATE '1998-12-31') AS recency_days
  FROM customer_totals JOIN customer ON c_custkey = customer_id
)
SELECT customer_id, """
    + ", ".join(
        f"round(({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER (), 6) + 0.0 AS {f}"
        for f in ("total_spend", "recency_days")
    )
    + """
FROM rated""",
    "sweep_scores": """
SELECT CAST(k AS INTEGER) AS k, true AS evaluator_agrees, true AS best_is_chosen
FROM range(2, 9) AS t(k)""",
    "run_segments": f"""WITH {TOTALS}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, n_transactions, total_spend, avg_spend,
       n_distinct_products, true AS has_segment
FROM customer_totals""",
    "run_gold_segments": f"""WITH {GOLD}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, avg_price, n_orders, last_purchase, province,
       total_payment
FROM gold""",
    "stored_model_segments": f"""WITH {TOTALS}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, true AS same_segment FROM customer_totals""",
    "report_by_province": f"""WITH {GOLD}
SELECT province, round(CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE), 2)
         AS total_purchases
FROM gold GROUP BY province""",
    "report_counts": f"""WITH {TOTALS}
SELECT count(*) AS n_customers, true AS averages_complete, true AS tops_complete,
       true AS top_is_short
FROM customer_totals""",
    "session_views": f"""WITH {CUSTOMERS}, {TOTALS},
known AS (SELECT * FROM customer_totals JOIN customers USING (customer_id))
SELECT 'transaction_metrics_view' AS view, count(DISTINCT order_id) AS n_rows
FROM items JOIN orders ON order_id = o_orderkey
UNION ALL SELECT 'customer_metrics_view', count(*) FROM customer_totals
UNION ALL SELECT 'product_metrics_view', count(DISTINCT product_id) FROM items
UNION ALL SELECT 'province_metrics_view', count(DISTINCT province) FROM known
UNION ALL SELECT 'city_metrics_view', count(*) FROM (SELECT DISTINCT province, city FROM known)
UNION ALL SELECT 'customer_segments_view', count(*) FROM customer_totals""",
    "features_without_nulls": f"""WITH {TOTALS}
SELECT customer_id, n_transactions, total_spend, avg_spend, n_distinct_products
FROM customer_totals WHERE customer_id % 5 <> 0 AND customer_id % 7 <> 0""",
    "refused_inputs": """
WITH known(table_name, last_column) AS (
  VALUES ('customers', 'province'), ('products', 'category'),
         ('transactions', 'estimated_arrival'), ('order_items', 'item_total'),
         ('reviews', 'review_date'), ('sellers', 'province')
)
SELECT table_name, 'whole' AS given, 'ready' AS said FROM known
UNION ALL SELECT table_name, 'emptied', table_name || ' is empty' FROM known
UNION ALL SELECT table_name, 'cut', table_name || ' lacks columns [' || chr(39) || last_column || chr(39) || ']'
          FROM known""",
    "fallback_profile": f"""WITH {_tiers()}
SELECT segment, count(DISTINCT customer_id) AS n_customers,
       round(avg(n_transactions), 4) AS avg_n_transactions,
       round(avg(total_spend), 4) AS avg_total_spend
FROM tiers GROUP BY segment""",
}
