"""DuckDB SQL of the descriptive reports and the data-quality risks."""

from oracles.features import _FEATURE_COLUMNS, ORACLES as _FEATURE_ORACLES
from oracles.prelude import with_features, with_sources, with_star

_DAYS = "Domingo Lunes Martes Miercoles Jueves Viernes Sabado".split()


def _describe(source: str, columns: list[str], percents: tuple[int, ...] = (25, 50, 75)) -> str:
    """One row per column with moments and interpolated percentiles."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,"
        f" round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max, "
        + ", ".join(f"round(quantile_cont({c}::DOUBLE, {p / 100}), 6) AS p{p}" for p in percents)
        + f" FROM {source}"
        for c in columns
    )


def _histogram(source: str, column: str, bins: int, cap: str | None = None) -> str:
    value = f"least({column}::DOUBLE, {cap})" if cap else f"{column}::DOUBLE"
    return (
        f"SELECT bin + 1 AS bin, round(lo + (hi - lo) / {bins} * bin, 6) AS lower, count(*) AS n FROM ("
        f"SELECT lo, hi, CAST(least(coalesce(floor((v - lo) * {bins} / nullif(hi - lo, 0)), 0), {bins - 1}) AS BIGINT) AS bin"
        f" FROM (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM (SELECT {value} AS v FROM {source}"
        f" WHERE {column} IS NOT NULL))) GROUP BY bin, lo, hi"
    )


def _thresholds(source: str, column: str, values: tuple[int, ...], op: str, name: str, digits: int = 6) -> str:
    return " UNION ALL ".join(
        f"SELECT {t}::BIGINT AS threshold, count(*) FILTER ({column} {op} {t}) AS {name},"
        f" round(count(*) FILTER ({column} {op} {t}) / count(*)::DOUBLE * 100, {digits}) AS pct FROM {source}"
        for t in values
    )


def _metrics(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, round(CAST(({q}) AS DOUBLE), 6) AS value" for n, q in parts.items()
    )


def _profile(tables: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls,"
        f" round(count(*) FILTER ({c} IS NULL) / count(*)::DOUBLE * 100, 2) AS null_pct,"
        f" count(DISTINCT {c}) AS distinct_values FROM {table}"
        for name, (table, columns) in tables.items()
        for c in columns.split()
    )


def _correlations(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


_PROXY = (
    "user_total_orders user_avg_basket_size user_days_since_last product_total_purchases product_reorder_rate"
    " up_times_purchased up_reorder_rate up_orders_since_last_purchase up_first_order_number up_last_order_number"
    " up_purchase_frequency up_avg_add_to_cart_order"
).split()
_PAIR_HISTOGRAMS = (
    "up_times_purchased up_avg_add_to_cart_order up_days_since_last up_avg_days_between_orders up_delta_days"
    " up_last_order_number"
).split()

_PER_USER = ", per_user AS (SELECT user_id, max(order_number) AS total_orders FROM src_orders GROUP BY user_id) "
_CARTS = (
    ", carts AS (SELECT user_id, order_id, order_number, count(*) AS cart_size FROM prior_full GROUP BY ALL),"
    " cart_means AS (SELECT user_id, avg(cart_size) AS mean_cart_per_user FROM carts GROUP BY user_id) "
)
_PRIOR_COUNT = (
    ", prior_count AS (SELECT user_id, count(*) AS prior_orders FROM src_orders WHERE eval_set = 'prior' GROUP BY user_id) "
)
_BOUGHT = (
    ", bought AS (SELECT product_id, count(*) AS purchases, avg(reordered) AS reorder_rate"
    " FROM prior_full GROUP BY product_id) "
)
_VOLUME = (
    _PER_USER.rstrip()
    + ", volume AS (SELECT b.user_id, b.total_products, b.reorder_rate, u.total_orders FROM"
    " (SELECT user_id, count(*) AS total_products, avg(reordered) AS reorder_rate FROM prior_full GROUP BY user_id) b"
    " JOIN per_user u USING (user_id)) "
)
_VOLUME_COLUMNS = (
    "user_id, total_products, round(reorder_rate, 6) AS reorder_rate, CAST(total_orders AS BIGINT) AS total_orders"
)
_RANKED = (
    _BOUGHT.rstrip()
    + ", ranked AS (SELECT product_id, purchases, row_number() OVER (ORDER BY purchases DESC, product_id) AS product_rank,"
    " count(*) OVER () AS products, sum(purchases) OVER () AS total,"
    " sum(purchases) OVER (ORDER BY purchases DESC, product_id) AS cumulative FROM bought) "
)
_LABELLED = (
    ", labelled AS (SELECT p.user_key, p.product_key, p.times, coalesce(t.label, 0) AS label FROM"
    " (SELECT user_key, product_key, count(*) AS times FROM prior GROUP BY ALL) p LEFT JOIN"
    " (SELECT DISTINCT user_key, product_key, 1 AS label FROM train) t USING (user_key, product_key)) "
)
_LEAKS = """
, last_order AS (SELECT user_id, count(*) FILTER (eval_set IN ('train', 'test')) AS evals, max(order_number) AS last
                 FROM src_orders GROUP BY user_id),
leaks AS (SELECT (SELECT count(*) FROM last_order WHERE evals > 1)
  + (SELECT count(*) FROM src_orders o JOIN last_order l USING (user_id)
     WHERE o.eval_set IN ('train', 'test') AND o.order_number <> l.last)
  + (SELECT count(*) FROM (SELECT order_id FROM src_orders WHERE eval_set = 'prior' INTERSECT
                           SELECT order_id FROM src_orders WHERE eval_set = 'train')) AS n)
"""
_BIAS = """
, marks AS (SELECT quantile_cont(purchases, 0.5) AS p50, quantile_cont(purchases, 0.75) AS p75,
                   quantile_cont(purchases, 0.9) AS p90, quantile_cont(purchases, 0.95) AS p95,
                   quantile_cont(purchases, 0.99) AS p99 FROM bought),
bias AS (SELECT count(*) FILTER (purchases >= p99) AS top_products,
                sum(purchases) FILTER (purchases >= p99) / sum(purchases)::DOUBLE AS top_share,
                corr(purchases, reorder_rate) AS correlation FROM bought, marks)
"""
_SPARSITY = (
    ", sparse AS (SELECT count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,"
    " count(DISTINCT (user_id, product_id)) AS observed FROM prior_full) "
)
_SUMMARY = {
    "users": "SELECT count(DISTINCT user_id) FROM src_orders",
    "products_in_prior": "SELECT count(DISTINCT product_id) FROM prior_full",
    "prior_orders": "SELECT count(*) FROM src_orders WHERE eval_set = 'prior'",
    "prior_items": "SELECT count(*) FROM prior_full",
    "reorder_rate": "SELECT avg(reordered) FROM prior_full",
    "median_orders_per_user": "SELECT median(total_orders) FROM per_user",
    "median_items_per_order": "SELECT median(cart_size) FROM carts",
    "median_days_between_orders": "SELECT median(days_since_prior_order) FROM src_orders",
    "peak_hour": "SELECT order_hour_of_day FROM src_orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    "peak_dow": "SELECT order_dow FROM src_orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    "sparsity_pct": "SELECT (1 - observed / (users * products)::DOUBLE) * 100 FROM sparse",
    "top_10_pct_share": "SELECT sum(purchases) FILTER (product_rank <= floor(products * 0.1::DOUBLE)) / max(total)::DOUBLE * 100"
    " FROM ranked",
}

ORACLES = {
    "profile_columns": with_sources(
        _profile(
            {
                "orders": (
                    "src_orders",
                    "order_id user_id eval_set order_number order_dow order_hour_of_day days_since_prior_order",
                ),
                "order_products_prior": ("prior_items", "order_id product_id add_to_cart_order reordered"),
                "order_products_train": ("train_items", "order_id product_id add_to_cart_order reordered"),
                "products": ("src_products", "product_id product_name aisle department"),
            }
        )
    ),
    "eda_structure": with_sources(
        _metrics(
            {
                "users": "SELECT count(DISTINCT user_id) FROM src_orders",
                "orders": "SELECT count(*) FROM src_orders",
                "products": "SELECT count(DISTINCT product_id) FROM src_products",
                "departments": "SELECT count(*) FROM src_departments",
                "aisles": "SELECT count(*) FROM src_aisles",
                "prior_items": "SELECT count(*) FROM prior_items",
                "train_items": "SELECT count(*) FROM train_items",
                "first_orders": "SELECT count(*) FROM src_orders WHERE days_since_prior_order IS NULL",
                "first_orders_match_users": "SELECT CASE WHEN count(*) FILTER (days_since_prior_order IS NULL)"
                " = count(DISTINCT user_id) THEN 1 ELSE 0 END FROM src_orders",
            }
        )
    ),
    "orders_per_user_stats": with_sources(_PER_USER + _describe("per_user", ["total_orders"])),
    "basket_stats": with_sources(
        _CARTS
        + _describe("carts", ["cart_size"], (50, 95))
        + " UNION ALL "
        + _describe("cart_means", ["mean_cart_per_user"], (50, 95))
    ),
    "hist_basket_clipped": with_sources(_CARTS + _histogram("carts", "cart_size", 49, "50")),
    "hist_orders_per_user": with_sources(_PER_USER + _histogram("per_user", "total_orders", 50)),
    "hist_days_between": with_sources(_histogram("src_orders", "days_since_prior_order", 30)),
    "hist_prior_orders_clipped": with_sources(_PRIOR_COUNT + _histogram("prior_count", "prior_orders", 29, "30")),
    "hist_product_purchases_clipped": with_sources(_BOUGHT + _histogram("bought", "purchases", 80, "200"), full=True),
    "hist_user_products_clipped": with_sources(
        ", up AS (SELECT user_id, count(DISTINCT product_id) AS products FROM prior_full GROUP BY user_id) "
        + _histogram("up", "products", 50, "300")
    ),
    "hist_pair_features": with_features(
        " UNION ALL ".join(
            f"SELECT *, '{c}' AS feature FROM ("
            + _histogram("matrix", c, 40, f"(SELECT quantile_cont({c}::DOUBLE, 0.99) FROM matrix)")
            + ")"
            for c in _PAIR_HISTOGRAMS
        )
    ),
    "orders_by_dow": with_sources(
        " UNION ALL ".join(
            f"SELECT {i}::BIGINT AS dow, '{d}' AS day, count(*) FILTER (order_dow = {i}) AS orders FROM src_orders"
            for i, d in enumerate(_DAYS)
        )
    ),
    "orders_by_hour": with_sources(
        "SELECT CAST(order_hour_of_day AS BIGINT) AS hour, count(*) AS orders FROM src_orders GROUP BY 1"
    ),
    "peak_slots": with_sources(
        "SELECT (SELECT order_hour_of_day FROM src_orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour,"
        f" list_extract({_DAYS}, 1 + (SELECT order_dow FROM src_orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))"
        " AS peak_day"
    ),
    "dow_hour_pivot": with_sources(
        "SELECT CAST(order_dow AS BIGINT) AS dow, "
        + ", ".join(f"count(*) FILTER (order_hour_of_day = {h}) AS h{h}" for h in range(24))
        + " FROM src_orders GROUP BY order_dow"
    ),
    "days_between_distribution": with_sources(
        "SELECT days_since_prior_order AS days, count(*) AS orders, days_since_prior_order IN (7, 14, 21, 30)"
        " AS highlighted FROM src_orders WHERE days_since_prior_order IS NOT NULL GROUP BY ALL"
    ),
    "days_last_stats": with_star(
        ", last_days AS (SELECT arg_max(days_since_prior_order, order_number) AS user_days_since_last_order FROM prior"
        " WHERE days_since_prior_order IS NOT NULL GROUP BY user_key) "
        + _describe("last_days", ["user_days_since_last_order"], (50, 95))
    ),
    "reorder_global": with_sources(
        "SELECT round(avg(reordered), 6) AS reorder_rate, count(*) AS items FROM prior_full"
    ),
    "reorder_class_balance": with_sources(
        "SELECT eval_set, count(*) FILTER (reordered = 0) AS class_0, count(*) FILTER (reordered = 1) AS class_1,"
        " round(count(*) FILTER (reordered = 0) / count(*)::DOUBLE, 6) AS share_0,"
        " round(count(*) FILTER (reordered = 1) / count(*)::DOUBLE, 6) AS share_1,"
        " round(count(*) FILTER (reordered = 1) / (count(*) FILTER (reordered = 0))::DOUBLE, 6) AS ratio_1_0"
        " FROM src_items WHERE eval_set <> 'test' GROUP BY eval_set"
    ),
    "reorder_by_cart_position": with_sources(
        "SELECT add_to_cart_order, round(avg(reordered), 6) AS reorder_rate FROM prior_full"
        " WHERE add_to_cart_order <= 15 GROUP BY add_to_cart_order"
    ),
    "reorder_by_department": with_sources(
        "SELECT department, round(avg(reordered), 6) AS reorder_rate, count(*) AS n_items,"
        " avg(reordered) > (SELECT avg(reordered) FROM prior_full) AS above_mean FROM prior_full GROUP BY department"
    ),
    "catalog_thresholds": with_sources(
        _BOUGHT + _thresholds("bought", "purchases", (10, 50, 100, 500, 1000), ">=", "products")
    ),
    "top_reordered_products": with_sources(
        "SELECT product_name, count(*) AS purchases, round(avg(reordered), 6) AS reorder_rate FROM prior_full"
        " GROUP BY product_name HAVING count(*) >= 50 ORDER BY avg(reordered) DESC, product_name LIMIT 20"
    ),
    "product_rate_filter_effect": with_sources(
        _BOUGHT
        + "SELECT count(*) AS products, count(*) FILTER (purchases >= 50) AS products_kept,"
        " round(avg(reorder_rate), 6) AS mean_rate, round(avg(reorder_rate) FILTER (purchases >= 50), 6) AS mean_rate_kept,"
        " count(*) FILTER (purchases < 50) AS excluded,"
        " round(count(*) FILTER (purchases < 50) / count(*)::DOUBLE, 6) AS excluded_share FROM bought"
    ),
    "user_volume_vs_reorder": with_sources(_VOLUME + f"SELECT {_VOLUME_COLUMNS} FROM volume"),
    "corr_orders_reorder": with_sources(
        _VOLUME + "SELECT round(corr(total_orders, reorder_rate), 6) AS correlation FROM volume"
    ),
    "top_products": with_sources(
        "SELECT product_name, count(*) AS purchases, left(product_name, 30) AS short_name FROM prior_full"
        " GROUP BY product_name ORDER BY purchases DESC, product_name LIMIT 20"
    ),
    "lorenz_curve": with_sources(
        _RANKED
        + "SELECT product_rank, product_id, purchases, round(product_rank / products::DOUBLE, 6) AS product_share,"
        " round(cumulative / total::DOUBLE, 6) AS purchase_share FROM ranked",
        full=True,
    ),
    "concentration_top_pct": with_sources(
        _RANKED
        + "SELECT count(*) AS products, round(sum(purchases) FILTER (product_rank <= floor(products * 0.01::DOUBLE))"
        " / max(total)::DOUBLE * 100, 6) AS top_1_pct_share,"
        " round(sum(purchases) FILTER (product_rank <= floor(products * 0.1::DOUBLE)) / max(total)::DOUBLE * 100, 6)"
        " AS top_10_pct_share, count(*) FILTER (purchases = 1) AS bought_once,"
        " round(count(*) FILTER (purchases = 1) / count(*)::DOUBLE * 100, 6) AS bought_once_pct FROM ranked",
        full=True,
    ),
    "department_share_top8": with_sources(
        """, d AS (SELECT department, count(*) AS items, row_number() OVER (ORDER BY count(*) DESC, department) AS rn
                   FROM prior_full GROUP BY department)
        SELECT CASE WHEN rn <= 8 THEN department ELSE 'Otros' END AS department, CAST(sum(items) AS BIGINT) AS items,
               round(sum(items) / (SELECT sum(items) FROM d)::DOUBLE, 6) AS share FROM d GROUP BY 1"""
    ),
    "top_aisles": with_sources(
        "SELECT department, aisle, count(*) AS items, concat(aisle, ' (', department, ')') AS label FROM prior_full"
        " GROUP BY department, aisle ORDER BY items DESC, department, aisle LIMIT 15"
    ),
    "catalog_by_department": with_sources(
        "SELECT department, count(*) AS products FROM src_products GROUP BY department", full=True
    ),
    "segment_summary": with_sources(
        _PER_USER
        + """, seg AS (SELECT user_id, CASE WHEN total_orders <= 5 THEN 1 WHEN total_orders <= 10 THEN 2
                 WHEN total_orders <= 20 THEN 3 WHEN total_orders <= 40 THEN 4 WHEN total_orders <= 100 THEN 5
                 ELSE 0 END AS segment FROM per_user),
        rates AS (SELECT user_id, avg(reordered) AS rate FROM prior_full GROUP BY user_id)
        SELECT CAST(segment AS BIGINT) AS segment, count(*) AS users, round(avg(rate), 6) AS mean_reorder_rate,
               round(count(*) / (SELECT count(*) FROM seg WHERE segment > 0)::DOUBLE, 6) AS share
        FROM seg LEFT JOIN rates USING (user_id) WHERE segment > 0 GROUP BY segment"""
    ),
    "cohort_basket": with_sources(
        _CARTS
        + "SELECT CAST(order_number AS BIGINT) AS order_number, round(avg(cart_size), 6) AS mean_cart_size FROM carts"
        " WHERE order_number <= 20 GROUP BY order_number"
    ),
    "sample_fraction": with_sources(
        _VOLUME
        + f"SELECT {_VOLUME_COLUMNS} FROM volume WHERE user_id IN (SELECT user_id FROM (SELECT user_id,"
        " row_number() OVER (ORDER BY md5(concat('42:', user_id)), user_id) AS rn, count(*) OVER () AS n FROM volume)"
        " WHERE rn <= round_even(n * 0.05, 0))"
    ),
    "matrix_sparsity": with_sources(
        _SPARSITY
        + "SELECT users, products, observed, users * products AS possible,"
        " round(1 - observed / (users * products)::DOUBLE, 6) AS sparsity FROM sparse",
        full=True,
    ),
    "cold_start_users": with_sources(
        _PRIOR_COUNT + _thresholds("prior_count", "prior_orders", (1, 2, 3, 5), "<=", "users")
    ),
    "cold_start_products": with_sources(
        _BOUGHT + _thresholds("bought", "purchases", (1, 5, 10, 20), "<=", "products"), full=True
    ),
    "catalog_coverage": with_sources(
        _metrics(
            {
                "catalogue": "SELECT count(DISTINCT product_id) FROM src_products",
                "in_prior": "SELECT count(DISTINCT product_id) FROM prior_items",
                "in_train": "SELECT count(DISTINCT product_id) FROM train_items",
                "in_both": "SELECT count(*) FROM (SELECT product_id FROM prior_items INTERSECT"
                " SELECT product_id FROM train_items)",
                "never_bought": "SELECT count(*) FROM (SELECT product_id FROM src_products EXCEPT"
                " SELECT product_id FROM prior_items)",
            }
        ),
        full=True,
    ),
    "co_purchase_pairs": with_sources(
        """, f AS (SELECT DISTINCT order_id, product_id FROM prior_full),
        t AS (SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS together
              FROM f a JOIN f b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY ALL
              ORDER BY together DESC, product_a, product_b LIMIT 15)
        SELECT t.*, a.product_name AS name_a, b.product_name AS name_b FROM t
        LEFT JOIN src_products a ON a.product_id = t.product_a LEFT JOIN src_products b ON b.product_id = t.product_b""",
        full=True,
    ),
    "matrix_correlations": with_features(_correlations("matrix", _FEATURE_COLUMNS)),
    "label_correlations": with_features(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(corr({c}, label), 6) AS correlation FROM matrix" for c in _FEATURE_COLUMNS
        )
    ),
    "eval_set_distribution": with_sources(
        "SELECT eval_set, count(*) AS orders, count(DISTINCT user_id) AS users,"
        " round(count(*) / (SELECT count(*) FROM src_orders)::DOUBLE, 6) AS share FROM src_orders GROUP BY eval_set"
    ),
    "user_coverage": with_sources(
        """, f AS (SELECT user_id, count(*) FILTER (eval_set = 'prior') AS p,
                          count(*) FILTER (eval_set = 'train') > 0 AS t FROM src_orders GROUP BY user_id) """
        + _metrics(
            {
                "total": "SELECT count(*) FROM f",
                "with_prior": "SELECT count(*) FROM f WHERE p > 0",
                "with_train": "SELECT count(*) FROM f WHERE t",
                "with_min_prior": "SELECT count(*) FROM f WHERE p >= 5",
                "full_coverage": "SELECT count(*) FROM f WHERE p >= 5 AND t",
                "excluded_no_train": "SELECT count(*) FROM f WHERE p > 0 AND NOT t",
                "excluded_few_prior": "SELECT count(*) FROM f WHERE p > 0 AND t AND p < 5",
                "excluded_total": "SELECT count(*) FROM f WHERE NOT (p >= 5 AND t)",
            }
        )
    ),
    "eda_summary": with_sources(
        _RANKED.rstrip() + _CARTS.rstrip() + _PER_USER.rstrip() + _SPARSITY + _metrics(_SUMMARY)
    ),
    "label_rate_by_segment": with_star(
        _LABELLED
        + """, u AS (SELECT user_key, count(DISTINCT order_key) AS n FROM prior GROUP BY user_key),
        s AS (SELECT user_key, CASE WHEN n <= 5 THEN 'Esporádico' WHEN n <= 10 THEN 'Ocasional'
                WHEN n <= 20 THEN 'Regular' WHEN n <= 40 THEN 'Frecuente' WHEN n <= 9999 THEN 'Power User' END AS segment
              FROM u)
        SELECT segment, round(avg(label), 6) AS label_rate, count(*) AS pairs FROM labelled JOIN s USING (user_key)
        GROUP BY segment"""
    ),
    "times_purchased_by_label": with_star(
        _LABELLED
        + "SELECT CAST(label AS BIGINT) AS label, least(times, 20) AS times, count(*) AS pairs FROM labelled GROUP BY 1, 2"
    ),
    "popularity_stats": with_sources(
        _BOUGHT
        + "SELECT count(*) AS products, round(count(*) FILTER (purchases >= 50) / count(*)::DOUBLE * 100, 6)"
        " AS pct_min_purchases, round(avg(purchases), 6) AS mean, round(avg(ln(1 + purchases)), 6) AS mean_log1p,"
        " round(median(purchases), 6) AS median, round(quantile_cont(purchases, 0.99), 6) AS p99 FROM bought",
        full=True,
    ),
    "feature_describe": with_features(_describe("matrix", _FEATURE_COLUMNS, (25, 50, 75, 99))),
    "cart_position_stats": with_star(_describe("prior", ["add_to_cart_order"], (50,))),
    "risk_class_imbalance": with_sources(
        """, c AS (SELECT count(*) FILTER (reordered = 0) AS class_0, count(*) FILTER (reordered = 1) AS class_1
                   FROM prior_items)
        SELECT class_0, class_1, round(class_0 / (class_0 + class_1)::DOUBLE, 4) AS class_0_pct,
               round(class_1 / (class_0 + class_1)::DOUBLE, 4) AS class_1_pct,
               round(class_0 / class_1::DOUBLE, 2) AS ratio_0_1,
               CASE WHEN class_0 / class_1::DOUBLE > 3 THEN 'ALTA' WHEN class_0 / class_1::DOUBLE > 1.5 THEN 'MEDIA'
                    ELSE 'BAJA' END AS severity FROM c"""
    ),
    "risk_cardinality": with_sources(
        "SELECT count(DISTINCT product_id) AS products, (SELECT count(DISTINCT product_id) FROM prior_items) AS bought,"
        " count(DISTINCT product_id) - (SELECT count(DISTINCT product_id) FROM prior_items) AS never_bought"
        " FROM src_products",
        full=True,
    ),
    "risk_long_tail": with_sources(
        _BOUGHT + _thresholds("bought", "purchases", (1, 5, 10, 50, 100), "<=", "products", 2), full=True
    ),
    "risk_pareto80": with_sources(
        _RANKED
        + "SELECT count(*) AS products, min(product_rank) FILTER (cumulative / total::DOUBLE * 100 >= 80)"
        " AS products_needed, round(min(product_rank) FILTER (cumulative / total::DOUBLE * 100 >= 80)"
        " / count(*)::DOUBLE * 100, 6) AS products_pct FROM ranked",
        full=True,
    ),
    "risk_user_sparsity": with_sources(
        _PRIOR_COUNT
        + " UNION ALL ".join(
            f"SELECT {t}::BIGINT AS threshold, n AS users, round(s, 4) AS share, CASE WHEN s > 0.2 THEN 'ALTA'"
            f" WHEN s > 0.1 THEN 'MEDIA' ELSE 'BAJA' END AS severity FROM (SELECT count(*) FILTER (prior_orders < {t}) AS n,"
            f" count(*) FILTER (prior_orders < {t}) / count(*)::DOUBLE AS s FROM prior_count)"
            for t in (3, 5, 10)
        )
    ),
    "risk_mean_sparsity": with_sources(
        "SELECT round(avg(1 - n / (SELECT count(DISTINCT product_id) FROM src_products)::DOUBLE), 6) AS mean_sparsity"
        " FROM (SELECT user_id, count(DISTINCT product_id) AS n FROM prior_full GROUP BY user_id)",
        full=True,
    ),
    "risk_popularity_bias": with_sources(
        _BOUGHT.rstrip()
        + _BIAS
        + "SELECT round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90, round(p95, 6) AS p95,"
        " round(p99, 6) AS p99, top_products, round(top_share, 6) AS top_share, round(correlation, 6) AS correlation"
        " FROM marks, bias",
        full=True,
    ),
    "risk_popularity_bins": with_sources(
        _BOUGHT
        + """, l AS (SELECT ln(1 + purchases) AS x, reorder_rate FROM bought),
        b AS (SELECT x, reorder_rate, min(x) OVER () AS lo, max(x) OVER () AS hi FROM l)
        SELECT CAST(least(ceil((x - lo) * 19 / (hi - lo)), 19) AS BIGINT) AS bin,
               round(avg(reorder_rate), 6) AS reorder_rate, count(*) AS products
        FROM b WHERE x > lo GROUP BY 1""",
        full=True,
    ),
    "risk_report": with_sources(
        _BOUGHT.rstrip()
        + _BIAS.rstrip()
        + _LEAKS
        + """, c AS (SELECT round(count(*) FILTER (reordered = 0) / (count(*) FILTER (reordered = 1))::DOUBLE, 2) AS r,
                     count(*) FILTER (reordered = 0) / (count(*) FILTER (reordered = 1))::DOUBLE AS x FROM prior_items),
        s AS (SELECT avg(1 - n / (SELECT count(*) FROM src_products)::DOUBLE) * 100 AS v
              FROM (SELECT user_id, count(DISTINCT product_id) AS n FROM prior_full GROUP BY user_id))
        SELECT 'Desbalance de clases' AS risk, concat('Ratio 0:1 = ', r) AS metric,
               CASE WHEN x > 3 THEN 'ALTA' WHEN x > 1.5 THEN 'MEDIA' ELSE 'BAJA' END AS severity,
               'class_weight / scale_pos_weight en el modelo' AS action FROM c
        UNION ALL SELECT 'Alta cardinalidad', concat(format('{:,}', count(*)), ' productos'), 'ALTA',
               'Filtrar productos con < 50 apariciones para el MVP' FROM src_products
        UNION ALL SELECT 'Sparsity de usuarios', concat('Sparsity media = ', printf('%.4f', v), '%'), 'ALTA',
               'Filtrar usuarios con < 5 órdenes / popularidad como fallback' FROM s
        UNION ALL SELECT 'Data leakage temporal', CASE WHEN n = 0 THEN 'Resultado: OK'
               ELSE 'Resultado: PROBLEMA DETECTADO' END, CASE WHEN n = 0 THEN 'OK' ELSE 'CRÍTICO' END,
               CASE WHEN n = 0 THEN 'Estructura prior/train/test respetada ✅' ELSE 'Revisar split temporal' END FROM leaks
        UNION ALL SELECT 'Sesgo hacia productos populares', concat('Top 1% = ', printf('%.1f', top_share * 100),
               '% compras'), 'MEDIA', 'Incluir features de popularidad relativa al usuario' FROM bias""",
        full=True,
    ),
}


def _proxy_body() -> str:
    """The proxy-matrix SQL as a CTE."""
    sql = _FEATURE_ORACLES["eda_proxy_matrix"]
    head, body = sql.rsplit("SELECT up.user_id", 1)
    exact = """SELECT up.*, u.user_total_orders, u.user_days_since_last, b.user_avg_basket_size,
      p.product_total_purchases, p.product_reorder_rate,
      u.user_max_order - up.up_last_order_number AS up_orders_since_last_purchase,
      up.up_times_purchased / CAST(u.user_total_orders AS DOUBLE) AS up_purchase_frequency
    FROM up JOIN u USING (user_id) JOIN b USING (user_id) JOIN p USING (product_id)"""
    return f"{head.rstrip()}, proxy AS ({exact})"


ORACLES["feature_correlations"] = _proxy_body() + " " + _correlations("proxy", _PROXY)
ORACLES["high_correlations"] = (
    _proxy_body() + f" SELECT * FROM ({_correlations('proxy', _PROXY)}) WHERE abs(correlation) > 0.7"
)
