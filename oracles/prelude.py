"""Shared CTEs: basket source tables and star schema derived from the provided tables."""

_SOURCES = """
seq AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev,
         count(*) OVER (PARTITION BY o_custkey) AS tot
  FROM orders),
src_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
         CASE WHEN n < tot THEN 'prior' WHEN o_custkey % 10 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         n AS order_number,
         dayofweek(o_orderdate) AS order_dow,
         o_orderkey % 24 AS order_hour_of_day,
         CAST(date_diff('day', prev, o_orderdate) AS DOUBLE) AS days_since_prior_order
  FROM seq),
lines AS (
  SELECT l_orderkey AS order_id, {product} AS product_id, min(l_linenumber) AS ln
  FROM lineitem GROUP BY l_orderkey, {product}),
src_items AS (
  SELECT o.order_id, o.user_id, o.eval_set, o.order_number, l.product_id, o.order_dow, o.order_hour_of_day,
         o.days_since_prior_order,
         row_number() OVER (PARTITION BY o.order_id ORDER BY l.ln, l.product_id) AS add_to_cart_order,
         CASE WHEN row_number() OVER (PARTITION BY o.user_id, l.product_id ORDER BY o.order_number) > 1
              THEN 1 ELSE 0 END AS reordered
  FROM src_orders o JOIN lines l ON l.order_id = o.order_id),
src_products AS (
  {products}),
src_aisles AS (SELECT DISTINCT aisle FROM src_products),
src_departments AS (SELECT DISTINCT department FROM src_products),
src_users AS (
  SELECT c_custkey AS user_id, c_name AS user_name, concat('Nation ', c_nationkey) AS user_address,
         16 + c_custkey % 65 AS user_age
  FROM customer),
prior_items AS (SELECT * FROM src_items WHERE eval_set = 'prior'),
train_items AS (SELECT * FROM src_items WHERE eval_set = 'train'),
prior_full AS (
  SELECT i.*, p.product_name, p.aisle, p.department
  FROM prior_items i JOIN src_products p ON p.product_id = i.product_id)
"""

_FOLDED_PRODUCTS = """SELECT p_partkey % 100 + 1 AS product_id,
         min_by(concat(p_name, ' #', p_partkey), p_partkey) AS product_name,
         min_by(p_name, p_partkey) AS aisle, min_by(p_brand, p_partkey) AS department
  FROM part GROUP BY p_partkey % 100 + 1"""
_ALL_PRODUCTS = """SELECT p_partkey AS product_id, concat(p_name, ' #', p_partkey) AS product_name,
         p_name AS aisle, p_brand AS department FROM part"""

SOURCES = _SOURCES.format(product="l_partkey % 100 + 1", products=_FOLDED_PRODUCTS)
SOURCES_FULL = _SOURCES.format(product="l_partkey", products=_ALL_PRODUCTS)

STAR = """
dim_user AS (
  SELECT u.user_id AS user_key, u.user_name, u.user_address,
         make_date(2001 - CAST(u.user_age AS INTEGER), 1, 1) AS user_birthdate
  FROM src_users u WHERE u.user_id IN (
    SELECT user_id FROM src_orders GROUP BY user_id
    HAVING sum(CASE WHEN eval_set = 'prior' THEN 1 ELSE 0 END) >= 5
       AND sum(CASE WHEN eval_set = 'train' THEN 1 ELSE 0 END) >= 1)),
dim_product AS (
  SELECT product_id AS product_key, product_name, aisle AS aisle_name, department AS department_name
  FROM src_products WHERE product_id IN (
    SELECT product_id FROM prior_items GROUP BY product_id HAVING count(*) >= 50)),
fact AS (
  SELECT order_id AS order_key, user_id AS user_key, product_id AS product_key, order_dow, order_hour_of_day,
         days_since_prior_order, add_to_cart_order, reordered, order_number, eval_set AS get_eval
  FROM src_items
  WHERE eval_set IN ('prior', 'train')
    AND user_id IN (SELECT user_key FROM dim_user) AND product_id IN (SELECT product_key FROM dim_product)),
prior AS (SELECT * FROM fact WHERE get_eval = 'prior'),
train AS (SELECT * FROM fact WHERE get_eval = 'train')
"""


def with_sources(body: str, full: bool = False) -> str:
    """Query over the operational tables."""
    return "WITH " + (SOURCES_FULL if full else SOURCES).strip() + _tail(body)


def with_star(body: str) -> str:
    """Query over the star schema."""
    return "WITH " + SOURCES.strip() + ",\n" + STAR.strip() + _tail(body)


def with_features(body: str) -> str:
    """Query over the star schema, the feature frames and the feature matrix."""
    from oracles.features import FEATURES

    return "WITH " + SOURCES.strip() + ",\n" + STAR.strip() + ",\n" + FEATURES.strip() + _tail(body)


def _tail(body: str) -> str:
    """A body starting with a comma adds CTEs, any other body is the final SELECT."""
    return ("" if body.lstrip().startswith(",") else "\n") + body.strip()
