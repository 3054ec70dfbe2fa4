"""DuckDB SQL of scans, sinks, the ETL and the integrity checks."""

from oracles.features import _FACT, MATRIX_COLUMNS, columns
from oracles.prelude import with_features, with_sources, with_star

_ORDERS = (
    "order_id, user_id, eval_set, CAST(order_number AS BIGINT) AS order_number, CAST(order_dow AS BIGINT) AS order_dow,"
    " CAST(order_hour_of_day AS BIGINT) AS order_hour_of_day, days_since_prior_order"
)
_ITEMS = (
    "order_id, product_id, CAST(add_to_cart_order AS BIGINT) AS add_to_cart_order,"
    " CAST(reordered AS BIGINT) AS reordered"
)
_DIM_USER = "user_key, user_name, user_address, CAST(user_birthdate AS VARCHAR) AS user_birthdate"

SAMPLED = (
    ", sampled AS (SELECT user_key FROM dim_user ORDER BY md5(concat('42:', user_key)), user_key LIMIT 1000)"
)
_RANGE = (
    ", bounds AS (SELECT floor(greatest(0, 90 / 364.0::DOUBLE) * max(order_number)) AS lo,"
    " floor(least(1, 272 / 364.0::DOUBLE) * max(order_number)) AS hi FROM fact),"
    " ranged AS (SELECT * FROM fact WHERE order_number BETWEEN (SELECT lo FROM bounds) AND (SELECT hi FROM bounds))"
)


def _counts(names: dict[str, str]) -> str:
    parts = [f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {t}" for n, t in names.items()]
    body = " UNION ALL ".join(parts)
    return f", counted AS ({body}) SELECT * FROM counted UNION ALL SELECT 'total', CAST(sum(rows) AS BIGINT) FROM counted"


def _rule(table: str, kind: str, names: str, broken: str) -> str:
    source = "fact" if table == "fact_order_products" else table
    return f"""SELECT '{table}' AS "table", '{kind}' AS kind, '{names}' AS columns, ({broken.format(t=source)}) AS violations"""


_REQUIRED = {
    "dim_user": ["user_key"],
    "dim_product": ["product_key", "product_name", "aisle_name", "department_name"],
    "fact_order_products": [
        "order_key", "user_key", "product_key", "order_dow", "order_hour_of_day", "add_to_cart_order", "reordered",
        "order_number", "get_eval",
    ],
}
_LENGTHS = [
    ("dim_user", "user_name", 150), ("dim_user", "user_address", 300), ("dim_product", "product_name", 300),
    ("dim_product", "aisle_name", 100), ("dim_product", "department_name", 100), ("fact_order_products", "get_eval", 10),
]
_CONSTRAINTS = " UNION ALL ".join(
    [_rule(t, "not_null", c, f"SELECT count(*) - count({c}) FROM {{t}}") for t, names in _REQUIRED.items() for c in names]
    + [_rule(t, "length", c, f"SELECT count(*) FILTER (length({c}) > {n}) FROM {{t}}") for t, c, n in _LENGTHS]
    + [_rule("fact_order_products", "check", "get_eval", "SELECT count(*) FILTER (get_eval NOT IN ('train', 'prior')) FROM {t}")]
    + [
        _rule(t, "primary_key", keys, f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {{t}})) FROM {{t}}")
        for t, keys in (("dim_user", "user_key"), ("dim_product", "product_key"), ("fact_order_products", "order_key, product_key"))
    ]
    + [
        _rule("fact_order_products", "foreign_key", k, f"SELECT count(*) FROM {{t}} WHERE {k} NOT IN (SELECT {k} FROM {d})")
        for k, d in (("user_key", "dim_user"), ("product_key", "dim_product"))
    ]
)

ORACLES = {
    "scan_csv_typed": with_sources(f"SELECT {_ORDERS} FROM src_orders"),
    "scan_parquet": with_features(f"SELECT {columns(MATRIX_COLUMNS)} FROM matrix"),
    "load_projection_cast": with_star(f"SELECT {_FACT} FROM fact"),
    "load_filter_users": with_star(
        SAMPLED + f" SELECT {_FACT} FROM fact WHERE user_key IN (SELECT user_key FROM sampled)"
    ),
    "sample_users": with_star(SAMPLED + " SELECT user_key FROM sampled"),
    "sample_propagate": with_sources(
        """, s AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM src_orders)
                   ORDER BY md5(concat('42:', user_id)), user_id LIMIT 1000),
        o AS (SELECT * FROM src_orders WHERE user_id IN (SELECT user_id FROM s))
        SELECT 'orders' AS "table", count(*) AS rows, CAST(sum(order_id) AS BIGINT) AS id_sum FROM o UNION ALL
        SELECT 'prior', count(*), CAST(sum(order_id) AS BIGINT) FROM prior_items WHERE order_id IN (SELECT order_id FROM o)
        UNION ALL
        SELECT 'train', count(*), CAST(sum(order_id) AS BIGINT) FROM train_items WHERE order_id IN (SELECT order_id FROM o)"""
    ),
    "date_range_order_proxy": with_star(_RANGE + f" SELECT {_FACT} FROM ranged"),
    "date_range_dim_user": with_star(
        _RANGE + f" SELECT {_DIM_USER} FROM dim_user WHERE user_key IN (SELECT user_key FROM ranged)"
    ),
    "sink_parquet_roundtrip": with_star(f"SELECT {_FACT} FROM fact"),
    "sink_insert_ignore": with_star(
        "SELECT CAST(order_key AS BIGINT) AS order_key, CAST(product_key AS BIGINT) AS product_key, get_eval FROM fact"
    ),
    "dim_user_backfill": with_star(
        "SELECT user_key, CASE WHEN user_birthdate < DATE '1960-01-01' THEN concat('New ', user_name) ELSE user_name END"
        " AS user_name, CASE WHEN user_birthdate < DATE '1960-01-01' THEN concat('Moved, ', user_address) ELSE user_address"
        " END AS user_address, CAST(user_birthdate AS VARCHAR) AS user_birthdate FROM dim_user"
    ),
    "table_counts": with_star(
        _counts(
            {
                "users": "src_users",
                "products": "src_products",
                "orders": "src_orders",
                "order_products_prior": "prior_items",
                "order_products_train": "train_items",
            }
        )
    ),
    "etl_eligible_users": with_sources(
        "SELECT user_id, count(*) FILTER (eval_set = 'prior') AS prior_orders,"
        " count(*) FILTER (eval_set = 'train') AS train_orders FROM src_orders GROUP BY user_id"
        " HAVING count(*) FILTER (eval_set = 'prior') >= 5 AND count(*) FILTER (eval_set = 'train') >= 1"
    ),
    "etl_dim_user": with_star(f"SELECT {_DIM_USER} FROM dim_user"),
    "etl_eligible_products": with_sources(
        "SELECT product_id, count(*) AS purchases FROM prior_items GROUP BY product_id HAVING count(*) >= 50"
    ),
    "etl_dim_product": with_star("SELECT product_key, product_name, aisle_name, department_name FROM dim_product"),
    "etl_union_items": with_sources(f"SELECT {_ITEMS} FROM prior_items UNION ALL SELECT {_ITEMS} FROM train_items"),
    "etl_fact": with_star(f"SELECT {_FACT} FROM fact"),
    "prior_full": with_sources(
        f"SELECT {_ITEMS}, user_id, CAST(order_number AS BIGINT) AS order_number, CAST(order_dow AS BIGINT) AS order_dow,"
        " CAST(order_hour_of_day AS BIGINT) AS order_hour_of_day, days_since_prior_order, product_name, aisle, department"
        " FROM prior_full"
    ),
    "load_report": with_star(
        "SELECT 'dim_user' AS \"table\", 'completed' AS state, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM dim_user"
        " UNION ALL SELECT 'dim_product', 'completed', count(*), NULL FROM dim_product"
        " UNION ALL SELECT 'fact_order_products', 'completed', count(*), NULL FROM fact"
    ),
    "star_constraints": with_star(_CONSTRAINTS),
    "etl_full_counts": with_star(
        "SELECT 'dim_user' AS \"table\", count(*) AS rows FROM dim_user UNION ALL"
        " SELECT 'dim_product', count(*) FROM dim_product UNION ALL SELECT 'fact_order_products', count(*) FROM fact"
    ),
    "v1_volume": with_star(
        "SELECT 'dim_user' AS \"table\", count(*) AS rows FROM dim_user UNION ALL"
        " SELECT 'dim_product', count(*) FROM dim_product UNION ALL SELECT 'fact_order_products', count(*) FROM fact"
    ),
    "v2_eval_distribution": with_star("SELECT get_eval, count(*) AS rows FROM fact GROUP BY get_eval"),
    "v3_eligible_users": with_star(
        """, visits AS (SELECT DISTINCT user_key, order_key FROM prior),
        ranked AS (SELECT user_key, row_number() OVER (PARTITION BY user_key ORDER BY order_key) AS nth FROM visits)
        SELECT count(*) FILTER (nth = 5) AS eligible_users FROM ranked"""
    ),
    "v4_eligible_products": with_star(
        "SELECT count(*) AS eligible_products FROM (SELECT product_key FROM fact GROUP BY product_key HAVING count(*) >= 50)"
    ),
    "v5_eligible_rows": with_star(
        """, cells AS (SELECT user_key, product_key, count(*) AS n FROM fact GROUP BY ALL),
        loyal AS (SELECT user_key, len(list_distinct(list(order_key))) AS visits FROM prior GROUP BY user_key),
        sold AS (SELECT product_key, sum(n) AS bought FROM cells GROUP BY product_key)
        SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS eligible_rows
        FROM cells JOIN loyal USING (user_key) JOIN sold USING (product_key) WHERE visits > 4 AND bought > 49"""
    ),
    "v6_null_days": with_star(
        """, gaps AS (SELECT days_since_prior_order IS NULL AS open, count(*) AS n FROM fact GROUP BY ALL)
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n * open::INTEGER) AS BIGINT) AS null_rows,
               round(100.0::DOUBLE * sum(n * open::INTEGER) / sum(n), 2) AS null_pct FROM gaps"""
    ),
    "v7_orphans": with_star(
        """SELECT 'fact' AS source, 'user' AS dimension, count(*) AS orphans FROM fact
             WHERE user_key NOT IN (SELECT user_key FROM dim_user)
           UNION ALL SELECT 'fact', 'product', count(*) FROM fact
             WHERE product_key NOT IN (SELECT product_key FROM dim_product)
           UNION ALL SELECT 'history', 'user', count(*) FROM src_items
             WHERE user_id NOT IN (SELECT user_key FROM dim_user)
           UNION ALL SELECT 'history', 'product', count(*) FROM src_items
             WHERE product_id NOT IN (SELECT product_key FROM dim_product)"""
    ),
    "v8_summary": with_star(
        """, carts AS (SELECT user_key, order_key, count(*) AS n, bool_or(get_eval = 'prior') AS before,
                              bool_or(get_eval = 'train') AS learn FROM fact GROUP BY ALL),
        people AS (SELECT user_key, sum(n) AS n, count(*) AS orders, bool_or(before) AS before, bool_or(learn) AS learn
                   FROM carts GROUP BY user_key)
        SELECT u.users_loaded, p.products_loaded, CAST(sum(n) AS BIGINT) AS facts_loaded,
               CAST(sum(orders) AS BIGINT) AS distinct_orders, count(*) FILTER (before) AS users_with_prior,
               count(*) FILTER (learn) AS users_with_train
        FROM people, (SELECT count(*) AS users_loaded FROM dim_user) u,
             (SELECT count(*) AS products_loaded FROM dim_product) p GROUP BY ALL"""
    ),
    "users_prior_and_train": with_star(
        "SELECT count(*) AS users_in_both FROM (SELECT user_key FROM prior INTERSECT SELECT user_key FROM train)"
    ),
    "star_expectations": with_star(
        """, seen AS (SELECT
             (SELECT count(*) FROM dim_user) AS users, (SELECT count(*) FROM dim_product) AS products,
             (SELECT count(*) FROM fact) AS facts, (SELECT count(*) FROM fact WHERE get_eval = 'test') AS test_rows,
             (SELECT count(*) FROM (SELECT user_key FROM prior INTERSECT SELECT user_key FROM train)) AS both_sets,
             (SELECT count(DISTINCT order_key) FROM fact) AS orders,
             (SELECT count(*) FROM fact ANTI JOIN dim_user USING (user_key)) AS lost_users,
             (SELECT count(*) FROM fact ANTI JOIN dim_product USING (product_key)) AS lost_products,
             (SELECT count(*) FROM src_orders WHERE eval_set <> 'test'
                AND user_id IN (SELECT user_key FROM dim_user)) AS expected_orders),
        good_users AS (SELECT user_id, count(*) FILTER (eval_set = 'prior') AS before,
                              count(*) FILTER (eval_set = 'train') AS learn FROM src_orders GROUP BY user_id
                       HAVING before >= 5 AND learn >= 1),
        good_products AS (SELECT product_id FROM src_items WHERE eval_set = 'prior' GROUP BY product_id HAVING count(*) >= 50),
        due AS (SELECT (SELECT count(*) FROM good_users) AS users, (SELECT count(*) FROM good_products) AS products,
                       (SELECT count(*) FROM src_items SEMI JOIN good_users USING (user_id)
                          SEMI JOIN good_products USING (product_id) WHERE eval_set <> 'test') AS facts)
        SELECT 'users' AS "check", seen.users = due.users AS passed, seen.users AS observed FROM seen, due
        UNION ALL SELECT 'products', seen.products = due.products, seen.products FROM seen, due
        UNION ALL SELECT 'facts', seen.facts = due.facts, seen.facts FROM seen, due
        UNION ALL SELECT 'test_rows', test_rows = 0, test_rows FROM seen
        UNION ALL SELECT 'orphan_users', lost_users = 0, lost_users FROM seen
        UNION ALL SELECT 'orphan_products', lost_products = 0, lost_products FROM seen
        UNION ALL SELECT 'users_in_both', both_sets >= users * 0.95, both_sets FROM seen
        UNION ALL SELECT 'orders', abs(orders - expected_orders) < 100, orders FROM seen"""
    ),
    "duplicate_pairs": with_sources(
        "SELECT eval_set, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT eval_set, l_orderkey, l_partkey,"
        " count(*) AS n FROM lineitem JOIN src_orders ON order_id = l_orderkey GROUP BY ALL) GROUP BY eval_set"
    ),
    "order_stats": with_sources(
        "SELECT count(*) AS orders, round(avg(days_since_prior_order), 6) AS avg_days,"
        " CAST(min(order_number) AS BIGINT) AS min_order_number, CAST(max(order_number) AS BIGINT) AS max_order_number"
        " FROM src_orders"
    ),
    "catalog_listing": with_star(
        "SELECT product_key, product_name, department_name, aisle_name FROM dim_product"
        " ORDER BY product_name, product_key LIMIT 20"
    ),
    "risk_temporal_leakage": with_sources(
        """, per_user AS (SELECT user_id, count(*) FILTER (eval_set IN ('train', 'test')) AS evals,
                                 max(order_number) AS last FROM src_orders GROUP BY user_id)
        SELECT 'users_with_several_eval_orders' AS "check", count(*) FILTER (evals > 1) AS violations FROM per_user
        UNION ALL SELECT 'eval_order_not_last', count(*) FROM src_orders o JOIN per_user u USING (user_id)
          WHERE o.eval_set IN ('train', 'test') AND o.order_number <> u.last
        UNION ALL SELECT 'order_ids_in_prior_and_train', count(*) FROM
          (SELECT order_id FROM src_orders WHERE eval_set = 'prior' INTERSECT
           SELECT order_id FROM src_orders WHERE eval_set = 'train')"""
    ),
}
