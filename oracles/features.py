"""DuckDB SQL of the feature frames, the feature matrix and the matrix reports."""

from oracles.prelude import with_features, with_sources, with_star

FEATURES = """
coded AS (
  SELECT p.product_key, p.department_name, p.aisle_name, d.code AS department_key, a.code AS aisle_key
  FROM dim_product p
  LEFT JOIN (SELECT department_name, dense_rank() OVER (ORDER BY department_name) - 1 AS code
             FROM (SELECT DISTINCT department_name FROM dim_product)) d USING (department_name)
  LEFT JOIN (SELECT aisle_name, dense_rank() OVER (ORDER BY aisle_name) - 1 AS code
             FROM (SELECT DISTINCT aisle_name FROM dim_product)) a USING (aisle_name)),
baskets AS (
  SELECT user_key, order_key, count(*) AS basket_size FROM prior GROUP BY user_key, order_key),
user_features AS (
  SELECT b.user_key, b.user_total_orders, b.user_avg_basket_size, l.days AS user_days_since_last_order,
         r.user_reorder_ratio, r.user_distinct_products,
         CASE WHEN b.user_total_orders <= 0 THEN 0 WHEN b.user_total_orders <= 5 THEN 1
              WHEN b.user_total_orders <= 10 THEN 2 WHEN b.user_total_orders <= 20 THEN 3
              WHEN b.user_total_orders <= 40 THEN 4 WHEN b.user_total_orders <= 101 THEN 5 ELSE 0 END
           AS user_segment_code
  FROM (SELECT user_key, count(*) AS user_total_orders, avg(basket_size) AS user_avg_basket_size
        FROM baskets GROUP BY user_key) b
  LEFT JOIN (SELECT user_key, arg_max(days_since_prior_order, order_number) AS days
             FROM prior WHERE days_since_prior_order IS NOT NULL GROUP BY user_key) l USING (user_key)
  LEFT JOIN (SELECT user_key, avg(reordered) AS user_reorder_ratio,
                    count(DISTINCT product_key) AS user_distinct_products
             FROM prior GROUP BY user_key) r USING (user_key)
  WHERE b.user_total_orders >= 5),
dept_rate AS (
  SELECT c.department_key, avg(f.reordered) AS p_department_reorder_rate
  FROM prior f JOIN coded c USING (product_key) GROUP BY c.department_key),
aisle_rate AS (
  SELECT c.aisle_key, avg(f.reordered) AS p_aisle_reorder_rate
  FROM prior f JOIN coded c USING (product_key) GROUP BY c.aisle_key),
product_features AS (
  SELECT s.*, d.p_department_reorder_rate, a.p_aisle_reorder_rate
  FROM (SELECT product_key, count(*) AS product_total_purchases, avg(reordered) AS product_reorder_rate,
               avg(add_to_cart_order) AS product_avg_add_to_cart,
               count(DISTINCT user_key) AS product_unique_users
        FROM prior GROUP BY product_key HAVING count(*) >= 50) s
  LEFT JOIN coded c USING (product_key)
  LEFT JOIN dept_rate d USING (department_key)
  LEFT JOIN aisle_rate a USING (aisle_key)),
pair_base AS (
  SELECT user_key, product_key, count(*) AS up_times_purchased, min(order_number) AS up_first_order_number,
         max(order_number) AS up_last_order_number, avg(add_to_cart_order) AS up_avg_add_to_cart_order,
         coalesce(sum(days_since_prior_order), 0) AS span
  FROM prior GROUP BY user_key, product_key),
user_orders AS (SELECT DISTINCT user_key, order_number, days_since_prior_order AS days FROM prior),
days_since AS (
  SELECT p.user_key, p.product_key, coalesce(sum(o.days), 0) AS up_days_since_last
  FROM pair_base p LEFT JOIN user_orders o
    ON o.user_key = p.user_key AND o.order_number > p.up_last_order_number
  GROUP BY p.user_key, p.product_key),
pair_features AS (
  SELECT b.user_key, b.product_key, b.up_times_purchased, b.up_first_order_number, b.up_last_order_number,
         b.up_avg_add_to_cart_order, d.up_days_since_last,
         CASE WHEN b.up_times_purchased > 1 THEN b.span / (b.up_times_purchased - 1) END
           AS up_avg_days_between_orders,
         d.up_days_since_last - CASE WHEN b.up_times_purchased > 1 THEN b.span / (b.up_times_purchased - 1) END
           AS up_delta_days
  FROM pair_base b JOIN days_since d USING (user_key, product_key)),
favorite_department AS (
  SELECT user_key, department_key AS u_favorite_department FROM (
    SELECT user_key, department_key,
           row_number() OVER (PARTITION BY user_key ORDER BY count(*) DESC, department_key) AS rn
    FROM prior JOIN coded USING (product_key) GROUP BY user_key, department_key) WHERE rn = 1),
favorite_aisle AS (
  SELECT user_key, aisle_key AS u_favorite_aisle FROM (
    SELECT user_key, aisle_key,
           row_number() OVER (PARTITION BY user_key ORDER BY count(*) DESC, aisle_key) AS rn
    FROM prior JOIN coded USING (product_key) GROUP BY user_key, aisle_key) WHERE rn = 1),
labels_true AS (SELECT DISTINCT user_key, product_key, 1 AS label FROM train),
matrix AS (
  SELECT p.user_key, p.product_key, u.user_total_orders, u.user_avg_basket_size, u.user_days_since_last_order,
         u.user_reorder_ratio, u.user_distinct_products, u.user_segment_code, f.product_total_purchases,
         f.product_reorder_rate, f.product_avg_add_to_cart, f.product_unique_users,
         f.p_department_reorder_rate, f.p_aisle_reorder_rate, p.up_times_purchased,
         p.up_times_purchased / CAST(u.user_total_orders AS DOUBLE) AS up_reorder_rate,
         greatest(u.user_total_orders - p.up_last_order_number, 0) AS up_orders_since_last_purchase,
         p.up_first_order_number, p.up_last_order_number, p.up_avg_add_to_cart_order, p.up_days_since_last,
         p.up_avg_days_between_orders, p.up_delta_days, d.u_favorite_department, a.u_favorite_aisle,
         coalesce(l.label, 0) AS label
  FROM pair_features p
  JOIN user_features u USING (user_key)
  JOIN product_features f USING (product_key)
  LEFT JOIN favorite_department d USING (user_key)
  LEFT JOIN favorite_aisle a USING (user_key)
  LEFT JOIN labels_true l USING (user_key, product_key))
"""

_FEATURE_COLUMNS = (
    "user_total_orders user_avg_basket_size user_days_since_last_order user_reorder_ratio "
    "user_distinct_products user_segment_code product_total_purchases product_reorder_rate "
    "product_avg_add_to_cart product_unique_users p_department_reorder_rate p_aisle_reorder_rate "
    "up_times_purchased up_reorder_rate up_orders_since_last_purchase up_first_order_number "
    "up_last_order_number up_avg_add_to_cart_order up_days_since_last up_avg_days_between_orders "
    "up_delta_days u_favorite_department u_favorite_aisle"
).split()
_BIGINTS = (
    "user_key product_key user_total_orders user_distinct_products user_segment_code product_total_purchases "
    "product_unique_users up_times_purchased up_orders_since_last_purchase up_first_order_number "
    "up_last_order_number u_favorite_department u_favorite_aisle label"
).split()


def columns(names: list[str]) -> str:
    """Select list with the comparable type of each matrix column."""
    return ", ".join(
        f"CAST({n} AS BIGINT) AS {n}" if n in _BIGINTS else f"round({n}, 6) AS {n}" for n in names
    )


def contract_columns(names: list[str]) -> str:
    """As :func:`columns`, with fractions stored as 32-bit floats by the contract."""
    return ", ".join(
        f"CAST({n} AS BIGINT) AS {n}"
        if n in _BIGINTS
        else f"round(CAST(CAST({n} AS FLOAT) AS DOUBLE), 6) AS {n}"
        for n in names
    )


MATRIX_COLUMNS = ["user_key", "product_key", *_FEATURE_COLUMNS, "label"]

_USER = "user_key user_total_orders user_avg_basket_size user_days_since_last_order user_reorder_ratio user_distinct_products user_segment_code".split()
_PRODUCT = "product_key product_total_purchases product_reorder_rate product_avg_add_to_cart product_unique_users p_department_reorder_rate p_aisle_reorder_rate".split()
_PAIR = "user_key product_key up_times_purchased up_first_order_number up_last_order_number up_avg_add_to_cart_order up_days_since_last up_avg_days_between_orders up_delta_days".split()

_FACT = """CAST(order_key AS BIGINT) AS order_key, CAST(user_key AS BIGINT) AS user_key,
  CAST(product_key AS BIGINT) AS product_key, CAST(order_dow AS BIGINT) AS order_dow,
  CAST(order_hour_of_day AS BIGINT) AS order_hour_of_day, days_since_prior_order,
  CAST(add_to_cart_order AS BIGINT) AS add_to_cart_order, CAST(reordered AS BIGINT) AS reordered,
  CAST(order_number AS BIGINT) AS order_number, get_eval"""

_CORR = _FEATURE_COLUMNS


def _null_rows() -> str:
    names = "p_department_reorder_rate p_aisle_reorder_rate up_avg_days_between_orders up_delta_days".split()
    return " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) FILTER ({n} IS NULL) AS null_count, "
        f"round(count(*) FILTER ({n} IS NULL) * 100.0 / count(*), 6)::DOUBLE AS null_pct FROM matrix"
        for n in names
    )


ORACLES = {
    "fe_prior": with_star(f"SELECT {_FACT} FROM prior"),
    "fe_train": with_star(f"SELECT {_FACT} FROM train"),
    "fe_product_codes": with_features(
        "SELECT product_key, department_name, aisle_name, CAST(department_key AS BIGINT) AS department_key,"
        " CAST(aisle_key AS BIGINT) AS aisle_key FROM coded"
    ),
    "fe_basket_size": with_features("SELECT user_key, order_key, basket_size FROM baskets"),
    "fe_last_days": with_features(
        "SELECT user_key, arg_max(days_since_prior_order, order_number) FILTER (days_since_prior_order IS NOT NULL)"
        " AS user_days_since_last_order FROM prior GROUP BY user_key"
    ),
    "fe_user_segment": with_features(
        "SELECT CAST(user_segment_code AS BIGINT) AS user_segment_code, count(*) AS users FROM user_features"
        " GROUP BY user_segment_code"
    ),
    "fe_user_features": with_features(f"SELECT {columns(_USER)} FROM user_features"),
    "fe_dept_rate": with_features(
        f"SELECT CAST(department_key AS BIGINT) AS department_key, round(p_department_reorder_rate, 6) AS"
        " p_department_reorder_rate FROM dept_rate"
    ),
    "fe_aisle_rate": with_features(
        f"SELECT CAST(aisle_key AS BIGINT) AS aisle_key, round(p_aisle_reorder_rate, 6) AS p_aisle_reorder_rate"
        " FROM aisle_rate"
    ),
    "fe_product_features": with_features(f"SELECT {columns(_PRODUCT)} FROM product_features"),
    "fe_pair_base": with_features(
        "SELECT "
        + columns("user_key product_key up_times_purchased up_first_order_number up_last_order_number up_avg_add_to_cart_order".split())
        + " FROM pair_base"
    ),
    "fe_days_since_last": with_features(
        f"SELECT {columns(['user_key', 'product_key', 'up_days_since_last'])} FROM days_since"
    ),
    "fe_avg_days_between": with_features(
        f"SELECT {columns(['user_key', 'product_key', 'up_avg_days_between_orders'])} FROM pair_features"
    ),
    "fe_pair_features": with_features(f"SELECT {columns(_PAIR)} FROM pair_features"),
    "fe_favorite_department": with_features(
        f"SELECT {columns(['user_key', 'u_favorite_department'])} FROM favorite_department"
    ),
    "fe_favorite_aisle": with_features(f"SELECT {columns(['user_key', 'u_favorite_aisle'])} FROM favorite_aisle"),
    "fe_label": with_features(f"SELECT {columns(['user_key', 'product_key', 'label'])} FROM labels_true"),
    "fe_leakage_violations": with_star(
        "SELECT p.user_key, CAST(p.m AS BIGINT) AS prior_max_order, CAST(t.m AS BIGINT) AS train_order"
        " FROM (SELECT user_key, max(order_number) AS m FROM prior GROUP BY user_key) p"
        " JOIN (SELECT user_key, max(order_number) AS m FROM train GROUP BY user_key) t USING (user_key)"
        " WHERE p.m >= t.m"
    ),
    "fe_multi_train_users": with_star(
        "SELECT user_key, count(DISTINCT order_number) AS train_orders FROM train GROUP BY user_key"
        " HAVING count(DISTINCT order_number) > 1"
    ),
    "fe_feature_matrix": with_features(f"SELECT {columns(MATRIX_COLUMNS)} FROM matrix"),
    "fe_label_balance": with_features(
        "SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,"
        " round(count(*) FILTER (label = 0) / CAST(greatest(count(*) FILTER (label = 1), 1) AS DOUBLE), 6) AS ratio"
        " FROM matrix"
    ),
    "fe_null_report": with_features(_null_rows()),
    "fe_matrix_summary": with_features(
        "SELECT count(*) AS rows, count(DISTINCT user_key) AS users, count(DISTINCT product_key) AS products FROM matrix"
    ),
    "publish_snapshot": with_features(f"SELECT {contract_columns(MATRIX_COLUMNS)} FROM matrix"),
    "snapshot_job": with_features(
        "SELECT count(*) AS rows, count(DISTINCT user_key) AS users, count(DISTINCT product_key) AS products FROM matrix"
    ),
    "eda_preview_user": with_sources(
        "SELECT o.*, r.u_reorder_rate, r.u_unique_prods FROM"
        " (SELECT user_id, count(DISTINCT order_id) AS u_n_orders, round(avg(days_since_prior_order), 6) AS u_avg_days"
        "  FROM src_orders WHERE eval_set = 'prior' GROUP BY user_id) o"
        " JOIN (SELECT user_id, round(avg(reordered), 6) AS u_reorder_rate, count(DISTINCT product_id) AS u_unique_prods"
        "  FROM prior_full GROUP BY user_id) r USING (user_id)"
    ),
    "eda_preview_product": with_sources(
        "SELECT product_id, count(DISTINCT order_id) AS p_n_orders, round(avg(reordered), 6) AS p_reorder_rate,"
        " round(avg(add_to_cart_order), 6) AS p_avg_cart_pos, count(DISTINCT user_id) AS p_n_unique_users"
        " FROM prior_full GROUP BY product_id"
    ),
    "eda_preview_pair": with_sources(
        "SELECT user_id, product_id, count(DISTINCT order_id) AS up_orders, round(avg(reordered), 6) AS up_reorder_rate,"
        " round(avg(add_to_cart_order), 6) AS up_avg_cart_pos, CAST(max(order_number) AS BIGINT) AS up_last_order"
        " FROM prior_full GROUP BY user_id, product_id"
    ),
    "eda_proxy_matrix": with_sources(
        """, u AS (SELECT user_id, count(DISTINCT order_id) AS user_total_orders,
                    avg(days_since_prior_order) AS user_days_since_last, max(order_number) AS user_max_order
             FROM src_orders WHERE eval_set = 'prior' GROUP BY user_id),
        b AS (SELECT user_id, avg(n) AS user_avg_basket_size FROM
               (SELECT user_id, order_id, count(*) AS n FROM prior_full GROUP BY user_id, order_id) GROUP BY user_id),
        p AS (SELECT product_id, count(DISTINCT order_id) AS product_total_purchases,
                     avg(reordered) AS product_reorder_rate FROM prior_full GROUP BY product_id),
        up AS (SELECT user_id, product_id, count(DISTINCT order_id) AS up_times_purchased,
                      avg(reordered) AS up_reorder_rate, max(order_number) AS up_last_order_number,
                      min(order_number) AS up_first_order_number, avg(add_to_cart_order) AS up_avg_add_to_cart_order
               FROM prior_full GROUP BY user_id, product_id)
        SELECT up.user_id, up.product_id, up.up_times_purchased, round(up.up_reorder_rate, 6) AS up_reorder_rate,
               CAST(up.up_last_order_number AS BIGINT) AS up_last_order_number,
               CAST(up.up_first_order_number AS BIGINT) AS up_first_order_number,
               round(up.up_avg_add_to_cart_order, 6) AS up_avg_add_to_cart_order,
               u.user_total_orders, round(u.user_days_since_last, 6) AS user_days_since_last,
               round(b.user_avg_basket_size, 6) AS user_avg_basket_size,
               p.product_total_purchases, round(p.product_reorder_rate, 6) AS product_reorder_rate,
               CAST(u.user_max_order - up.up_last_order_number AS BIGINT) AS up_orders_since_last_purchase,
               round(up.up_times_purchased / CAST(u.user_total_orders AS DOUBLE), 6) AS up_purchase_frequency
        FROM up JOIN u USING (user_id) JOIN b USING (user_id) JOIN p USING (product_id)"""
    ),
}
