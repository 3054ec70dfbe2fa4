"""DuckDB SQL of validation, drift, split, metrics and recommendation."""

from oracles.features import columns
from oracles.prelude import with_features, with_sources

# --- split --------------------------------------------------------------------------------------
SPLIT = """
, ranked_users AS (
  SELECT user_key, row_number() OVER (ORDER BY md5(concat('42:', user_key)), user_key) - 1 AS pos,
         count(*) OVER () AS n FROM (SELECT DISTINCT user_key FROM matrix)),
split AS (
  SELECT user_key, CASE WHEN pos < n - (3 * n + 9) // 10 THEN 'train'
         WHEN pos < n - ((3 * n + 9) // 10 + 1) // 2 THEN 'val' ELSE 'test' END AS split FROM ranked_users),
split_matrix AS (SELECT m.*, s.split FROM matrix m JOIN split s USING (user_key)),
train_m AS (SELECT * FROM split_matrix WHERE split = 'train'),
test_m AS (SELECT *, up_reorder_rate AS score FROM split_matrix WHERE split = 'test'),
popular AS (
  SELECT product_key, avg(product_total_purchases) AS popularity FROM train_m GROUP BY product_key
  ORDER BY popularity DESC, product_key LIMIT 10),
top_k AS (
  SELECT * FROM (SELECT user_key, product_key, label, score,
    row_number() OVER (PARTITION BY user_key ORDER BY score DESC, product_key) AS rank FROM test_m) WHERE rank <= 10)
"""

_USER_FEATURES = (
    "user_total_orders user_avg_basket_size user_days_since_last_order user_reorder_ratio user_distinct_products"
).split()
_PRODUCT_FEATURES = (
    "product_total_purchases product_reorder_rate product_avg_add_to_cart product_unique_users"
    " p_department_reorder_rate"
).split()


def _means(features: list[str]) -> str:
    return ", ".join(f"round(avg({f}), 6) AS {f}" for f in features)


def _scaled(entity: str, key: str, features: list[str]) -> str:
    means = ", ".join(f"avg({f}) AS {f}" for f in features)
    fills = ", ".join(f"coalesce({f}, (SELECT median({f}) FROM raw_{entity})) AS {f}" for f in features)
    parts = " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, {key} AS entity_key, '{f}' AS feature,"
        f" round(({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () = 0 THEN 1.0"
        f" ELSE stddev_pop({f}) OVER () END, 6) + 0.0 AS value FROM filled_{entity}"
        for f in features
    )
    return (
        f", raw_{entity} AS (SELECT {key}, {means} FROM train_m GROUP BY {key}),"
        f" filled_{entity} AS (SELECT {key}, {fills} FROM raw_{entity}),"
        f" scaled_{entity} AS ({parts})"
    )


_CONFUSION = """count(*) FILTER (pred AND label = 1) AS tp, count(*) FILTER (pred AND label = 0) AS fp,
  count(*) FILTER (NOT pred AND label = 1) AS fn, count(*) FILTER (NOT pred AND label = 0) AS tn"""
_RATES = """tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""

# --- drift --------------------------------------------------------------------------------------
_MONITORED = (
    "user_total_orders user_avg_basket_size user_reorder_ratio product_total_purchases product_reorder_rate"
    " up_times_purchased up_reorder_rate up_days_since_last"
).split()


def _long(side: str, condition: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, '{side}' AS side, CAST({f} AS DOUBLE) AS value FROM split_matrix WHERE {condition}"
        for f in _MONITORED
    )


DRIFT = (
    SPLIT
    + f", long AS ({_long('ref', 'split = $$train$$')} UNION ALL {_long('cur', 'split <> $$train$$')}),"
    + """
ref AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS i,
               count(*) OVER (PARTITION BY feature) AS n FROM long WHERE side = 'ref' AND value IS NOT NULL),
edges AS (
  SELECT DISTINCT l.feature, l.value + (h.value - l.value) * (((p * 10 * (l.n - 1)) % 100) / 100.0::DOUBLE) AS edge
  FROM range(0, 11) r(p)
  JOIN ref l ON l.i = (p * 10 * (l.n - 1)) // 100
  JOIN ref h ON h.feature = l.feature AND h.i = least((p * 10 * (l.n - 1)) // 100 + 1, l.n - 1)),
bins AS (
  SELECT feature, edge AS lo, lead(edge) OVER (PARTITION BY feature ORDER BY edge) AS hi,
         max(edge) OVER (PARTITION BY feature) AS last FROM edges),
binned AS (
  SELECT b.feature, b.lo, count(*) FILTER (l.side = 'ref') AS n_ref, count(*) FILTER (l.side = 'cur') AS n_cur
  FROM bins b LEFT JOIN long l ON l.feature = b.feature AND l.value >= b.lo
    AND (l.value < b.hi OR (b.hi = b.last AND l.value = b.hi))
  WHERE b.hi IS NOT NULL GROUP BY b.feature, b.lo),
sizes AS (SELECT feature, count(*) FILTER (side = 'ref') AS t_ref, count(*) FILTER (side = 'cur') AS t_cur
          FROM long WHERE value IS NOT NULL GROUP BY feature),
psi AS (
  SELECT s.feature, coalesce(sum(((n_cur + 1e-6) / t_cur - (n_ref + 1e-6) / t_ref)
         * ln(((n_cur + 1e-6) / t_cur) / ((n_ref + 1e-6) / t_ref))), 0) AS psi
  FROM sizes s LEFT JOIN binned b USING (feature) GROUP BY s.feature),
ks AS (
  SELECT feature, max(abs(c_ref / t_ref::DOUBLE - c_cur / t_cur::DOUBLE)) AS ks FROM (
    SELECT feature, value, sum(n_ref) OVER w AS c_ref, sum(n_cur) OVER w AS c_cur FROM (
      SELECT feature, value, count(*) FILTER (side = 'ref') AS n_ref, count(*) FILTER (side = 'cur') AS n_cur
      FROM long WHERE value IS NOT NULL GROUP BY feature, value)
    WINDOW w AS (PARTITION BY feature ORDER BY value)) JOIN sizes USING (feature) GROUP BY feature),
by_feature AS (SELECT feature, round(psi, 4) AS psi, round(ks, 4) AS ks FROM psi JOIN ks USING (feature))
"""
)

# --- recommendation -----------------------------------------------------------------------------
REC = """
, requests AS (SELECT user_id AS user_key FROM src_users UNION ALL SELECT max(user_id) + 1 FROM src_users),
hist AS (SELECT user_id AS user_key, order_id AS order_key, product_id AS product_key, order_number, reordered,
                add_to_cart_order, days_since_prior_order FROM prior_items),
counted AS (
  SELECT r.user_key, coalesce(h.n, 0) AS n_orders FROM requests r
  LEFT JOIN (SELECT user_key, count(DISTINCT order_key) AS n FROM hist GROUP BY user_key) h USING (user_key)),
routed AS (
  SELECT c.user_key, n_orders, CASE WHEN n_orders = 0 AND u.user_id IS NULL THEN 'global'
         WHEN n_orders = 0 THEN 'error' WHEN n_orders < 5 THEN 'personal' ELSE 'model' END AS route
  FROM counted c LEFT JOIN src_users u ON u.user_id = c.user_key),
personal AS (
  SELECT user_key, rank, product_key, round(n / n_orders::DOUBLE, 4) AS probability FROM (
    SELECT h.user_key, h.product_key, count(*) AS n, any_value(r.n_orders) AS n_orders,
           row_number() OVER (PARTITION BY h.user_key ORDER BY count(*) DESC, h.product_key) AS rank
    FROM hist h JOIN routed r USING (user_key) WHERE r.route = 'personal' GROUP BY h.user_key, h.product_key)
  WHERE rank <= 10),
global_top AS (
  SELECT row_number() OVER (ORDER BY count(*) DESC, product_key) AS rank, product_key,
         round(count(*) / (SELECT count(*) FROM hist)::DOUBLE, 6) AS probability
  FROM hist GROUP BY product_key ORDER BY count(*) DESC, product_key LIMIT 10),
cat_features AS (
  SELECT p.product_key, s.product_total_purchases, s.product_reorder_rate, s.product_avg_add_to_cart,
         s.product_unique_users, d.p_department_reorder_rate, a.p_aisle_reorder_rate
  FROM dim_product p
  LEFT JOIN (SELECT product_key, count(*) AS product_total_purchases, avg(reordered) AS product_reorder_rate,
                    avg(add_to_cart_order) AS product_avg_add_to_cart, count(DISTINCT user_key) AS product_unique_users
             FROM hist GROUP BY product_key) s USING (product_key)
  LEFT JOIN (SELECT department_name, avg(reordered) AS p_department_reorder_rate
             FROM hist JOIN dim_product USING (product_key) GROUP BY department_name) d USING (department_name)
  LEFT JOIN (SELECT aisle_name, avg(reordered) AS p_aisle_reorder_rate
             FROM hist JOIN dim_product USING (product_key) GROUP BY aisle_name) a USING (aisle_name)),
own AS (SELECT h.* FROM hist h JOIN routed r USING (user_key) WHERE r.route = 'model'),
own_users AS (
  SELECT b.*, l.days AS user_days_since_last_order, r.user_reorder_ratio, r.user_distinct_products,
         CASE WHEN user_total_orders <= 0 THEN 0 WHEN user_total_orders <= 5 THEN 1 WHEN user_total_orders <= 10 THEN 2
              WHEN user_total_orders <= 20 THEN 3 WHEN user_total_orders <= 40 THEN 4
              WHEN user_total_orders <= 101 THEN 5 ELSE 0 END AS user_segment_code
  FROM (SELECT user_key, count(*) AS user_total_orders, avg(n) AS user_avg_basket_size FROM
        (SELECT user_key, order_key, count(*) AS n FROM own GROUP BY user_key, order_key) GROUP BY user_key) b
  LEFT JOIN (SELECT user_key, arg_max(days_since_prior_order, order_number) AS days FROM own
             WHERE days_since_prior_order IS NOT NULL GROUP BY user_key) l USING (user_key)
  LEFT JOIN (SELECT user_key, avg(reordered) AS user_reorder_ratio, count(DISTINCT product_key) AS user_distinct_products
             FROM own GROUP BY user_key) r USING (user_key)),
own_base AS (
  SELECT user_key, product_key, count(*) AS up_times_purchased, min(order_number) AS up_first_order_number,
         max(order_number) AS up_last_order_number, avg(add_to_cart_order) AS up_avg_add_to_cart_order,
         coalesce(sum(days_since_prior_order), 0) AS span FROM own GROUP BY user_key, product_key),
own_orders AS (SELECT DISTINCT user_key, order_number, days_since_prior_order AS days FROM own),
own_days AS (
  SELECT p.user_key, p.product_key, coalesce(sum(o.days), 0) AS up_days_since_last
  FROM own_base p LEFT JOIN own_orders o ON o.user_key = p.user_key AND o.order_number > p.up_last_order_number
  GROUP BY p.user_key, p.product_key),
own_dept AS (
  SELECT user_key, department_key AS u_favorite_department FROM (
    SELECT user_key, department_key, row_number() OVER (PARTITION BY user_key ORDER BY count(*) DESC, department_key) AS rn
    FROM own JOIN coded USING (product_key) GROUP BY user_key, department_key) WHERE rn = 1),
own_aisle AS (
  SELECT user_key, aisle_key AS u_favorite_aisle FROM (
    SELECT user_key, aisle_key, row_number() OVER (PARTITION BY user_key ORDER BY count(*) DESC, aisle_key) AS rn
    FROM own JOIN coded USING (product_key) GROUP BY user_key, aisle_key) WHERE rn = 1),
scoring AS (
  SELECT b.user_key, b.product_key, u.user_total_orders, u.user_avg_basket_size, u.user_days_since_last_order,
         u.user_reorder_ratio, u.user_distinct_products, u.user_segment_code, c.product_total_purchases,
         c.product_reorder_rate, c.product_avg_add_to_cart, c.product_unique_users, c.p_department_reorder_rate,
         c.p_aisle_reorder_rate, b.up_times_purchased,
         b.up_times_purchased / u.user_total_orders::DOUBLE AS up_reorder_rate,
         greatest(u.user_total_orders - b.up_last_order_number, 0) AS up_orders_since_last_purchase,
         b.up_first_order_number, b.up_last_order_number, b.up_avg_add_to_cart_order, d.up_days_since_last,
         CASE WHEN up_times_purchased > 1 THEN span / (up_times_purchased - 1) END AS up_avg_days_between_orders,
         d.up_days_since_last - CASE WHEN up_times_purchased > 1 THEN span / (up_times_purchased - 1) END AS up_delta_days,
         fd.u_favorite_department, fa.u_favorite_aisle
  FROM own_base b JOIN own_days d USING (user_key, product_key) JOIN own_users u USING (user_key)
  JOIN cat_features c USING (product_key) LEFT JOIN own_dept fd USING (user_key) LEFT JOIN own_aisle fa USING (user_key)
  WHERE c.product_total_purchases >= 50),
rule_top AS (
  SELECT * FROM (SELECT user_key, row_number() OVER (PARTITION BY user_key ORDER BY up_reorder_rate DESC, product_key)
                   AS rank, product_key, up_reorder_rate AS probability FROM scoring) WHERE rank <= 10)
"""
_SCORING = (
    "user_key product_key user_total_orders user_avg_basket_size user_days_since_last_order user_reorder_ratio"
    " user_distinct_products user_segment_code product_total_purchases product_reorder_rate product_avg_add_to_cart"
    " product_unique_users p_department_reorder_rate p_aisle_reorder_rate up_times_purchased up_reorder_rate"
    " up_orders_since_last_purchase up_first_order_number up_last_order_number up_avg_add_to_cart_order"
    " up_days_since_last up_avg_days_between_orders up_delta_days u_favorite_department u_favorite_aisle"
).split()
_NULLABLE = (
    "p_department_reorder_rate p_aisle_reorder_rate up_avg_days_between_orders up_delta_days".split()
)
_REQUIRED = (
    "user_key product_key user_total_orders user_avg_basket_size user_days_since_last_order user_reorder_ratio"
    " user_distinct_products user_segment_code product_total_purchases product_reorder_rate product_avg_add_to_cart"
    " product_unique_users up_times_purchased up_reorder_rate up_orders_since_last_purchase up_first_order_number"
    " up_last_order_number up_avg_add_to_cart_order up_days_since_last u_favorite_department u_favorite_aisle label"
).split()
_RATES_IN_UNIT = (
    "user_reorder_ratio product_reorder_rate p_department_reorder_rate p_aisle_reorder_rate up_reorder_rate".split()
)


def _check(name: str, bad: str, text: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", ({bad}) = 0 AS passed,"
        f" CASE WHEN ({bad}) > 0 THEN concat({bad}, ' {text}') ELSE '' END AS detail FROM matrix"
    )


_VALIDATE = " UNION ALL ".join(
    [
        "SELECT 'columns_present' AS \"check\", true AS passed, '' AS detail",
        _check(
            "no_unexpected_nulls",
            "CAST(sum(" + " + ".join(f"({c} IS NULL)::INT" for c in _REQUIRED) + ") AS BIGINT)",
            "null values",
        ),
        _check("label_binary", "count(*) FILTER (label NOT IN (0, 1))", "labels outside 0 and 1"),
        _check(
            "up_times_purchased_positive",
            "count(*) FILTER (up_times_purchased <= 0)",
            "rows with up_times_purchased <= 0",
        ),
        _check(
            "user_total_orders_positive",
            "count(*) FILTER (user_total_orders <= 0)",
            "rows with user_total_orders <= 0",
        ),
        _check(
            "no_duplicate_pairs",
            "count(*) - count(DISTINCT (user_key, product_key))",
            "duplicate (user_key, product_key) rows",
        ),
    ]
)
_EXTENDED = " UNION ALL ".join(
    [_check(f"{c}_in_unit_range", f"count(*) FILTER ({c} < 0 OR {c} > 1)", "failing") for c in _RATES_IN_UNIT]
    + [
        _check(
            "class_ratio_between_3_and_50",
            "CASE WHEN count(*) FILTER (label = 0) / count(*) FILTER (label = 1)::DOUBLE BETWEEN 3 AND 50 THEN 0 ELSE 1 END",
            "failing",
        ),
        _check(
            "both_classes_present",
            "CASE WHEN count(*) FILTER (label = 0) > 0 AND count(*) FILTER (label = 1) > 0 THEN 0 ELSE 1 END",
            "failing",
        ),
    ]
    + [_check(f"{c}_not_all_null", f"CASE WHEN count({c}) > 0 THEN 0 ELSE 1 END", "failing") for c in _NULLABLE]
    + [_check(f"{c}_positive", f"count(*) FILTER ({c} <= 0)", "failing") for c in ("user_key", "product_key")]
    + [
        _check(f"{c}_not_negative", f"count(*) FILTER ({c} < 0)", "failing")
        for c in ("user_total_orders", "product_total_purchases", "up_times_purchased", "user_distinct_products")
    ]
    + [
        _check(f"{c}_is_fractional", f"CASE WHEN max(typeof({c})) IN ('FLOAT', 'DOUBLE') THEN 0 ELSE 1 END", "failing")
        for c in ("user_avg_basket_size", "user_reorder_ratio", "product_reorder_rate", "up_reorder_rate")
    ]
    + [_check("label_is_integer", "CASE WHEN max(typeof(label)) LIKE '%INT%' THEN 0 ELSE 1 END", "failing")]
)

_BATCH = """, found AS (
  SELECT user_key, rank, product_key, probability, false AS cold_start FROM rule_top
  UNION ALL SELECT user_key, rank, product_key, probability, true FROM personal
  UNION ALL SELECT r.user_key, g.rank, g.product_key, g.probability, true
    FROM routed r, global_top g WHERE r.route = 'global')
SELECT f.user_key, f.rank, f.product_key, round(f.probability, 6) AS probability,
       coalesce(d.product_name, '') AS product_name, f.cold_start, '' AS error
FROM found f LEFT JOIN dim_product d USING (product_key)
UNION ALL SELECT user_key, 0, -1, 0.0, '', false, 'no prior history' FROM routed WHERE route = 'error'
UNION ALL SELECT user_key, 0, -1, 0.0, '', false, 'no product with enough purchases' FROM routed
  WHERE route = 'model' AND user_key NOT IN (SELECT user_key FROM scoring)"""

ORACLES = {
    "validate_nulls": with_features(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM matrix" for c in _REQUIRED
        )
    ),
    "validate_matrix": with_features(_VALIDATE),
    "validate_extended": with_features(_EXTENDED),
    "fe_one_hot": with_features(
        "SELECT user_key, product_key, "
        + ", ".join(f"CAST(coalesce(user_segment_code = {c}, false) AS BIGINT) AS user_segment_code_{c}" for c in range(1, 6))
        + " FROM matrix"
    ),
    "drift_psi": with_features(DRIFT + "SELECT feature, round(psi, 6) AS psi FROM psi"),
    "drift_ks": with_features(DRIFT + "SELECT feature, round(ks, 6) AS ks FROM ks"),
    "drift_by_feature": with_features(DRIFT + "SELECT * FROM by_feature"),
    "drift_report": with_features(
        DRIFT
        + "SELECT round(avg(psi), 3) AS psi, round(avg(ks), 3) AS ks, count(*) AS features,"
        " round(avg(psi), 3) > 0.25 OR round(avg(ks), 3) > 0.3 AS drift_detected FROM by_feature"
    ),
    "drift_class": with_features(
        DRIFT
        + "SELECT feature, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END"
        " AS stability FROM by_feature"
    ),
    "split_users": with_features(SPLIT + "SELECT user_key, split FROM split"),
    "split_sizes": with_features(
        SPLIT + "SELECT split, count(DISTINCT user_key) AS users, count(*) AS pairs FROM split_matrix GROUP BY split"
    ),
    "profile_user": with_features(
        SPLIT + f"SELECT user_key, {_means(_USER_FEATURES)} FROM train_m GROUP BY user_key"
    ),
    "profile_product": with_features(
        SPLIT + f"SELECT product_key, {_means(_PRODUCT_FEATURES)} FROM train_m GROUP BY product_key"
    ),
    "profile_scaled": with_features(
        SPLIT
        + _scaled("user", "user_key", _USER_FEATURES)
        + _scaled("product", "product_key", _PRODUCT_FEATURES)
        + " SELECT * FROM scaled_user UNION ALL SELECT * FROM scaled_product"
    ),
    "class_weight": with_features(
        "SELECT round(count(*) FILTER (label = 0) / greatest(count(*) FILTER (label = 1), 1)::DOUBLE, 6)"
        " AS scale_pos_weight FROM matrix"
    ),
    "eval_confusion": with_features(
        SPLIT
        + f", c AS (SELECT {_CONFUSION} FROM (SELECT label, score >= 0.5 AS pred FROM test_m)) SELECT {_RATES} FROM c"
    ),
    "eval_auc": with_features(
        SPLIT
        + """, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE
                     AS rk FROM test_m)
        SELECT round((sum(rk) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * n)::DOUBLE, 6) AS auc
        FROM r, (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM test_m) GROUP BY p, n"""
    ),
    "baseline_popularity": with_features(SPLIT + "SELECT product_key, round(popularity, 6) AS popularity FROM popular"),
    "baseline_metrics": with_features(
        SPLIT
        + f", c AS (SELECT {_CONFUSION} FROM (SELECT label, product_key IN (SELECT product_key FROM popular) AS pred"
        f" FROM test_m)) SELECT {_RATES} FROM c"
    ),
    "topk_per_user": with_features(
        SPLIT + "SELECT user_key, product_key, rank, round(score, 6) AS score FROM top_k"
    ),
    "uplift_topk": with_features(
        SPLIT
        + """, m AS (SELECT avg(h) AS v, count(*) AS users FROM
                      (SELECT user_key, sum(label) AS h FROM top_k GROUP BY user_key)),
        b AS (SELECT avg(h) AS v, sum(h) AS s FROM (SELECT user_key,
                count(*) FILTER (product_key IN (SELECT product_key FROM popular)) AS h
              FROM test_m WHERE label = 1 GROUP BY user_key))
        SELECT round(m.v, 6) AS model_hits, round(b.v, 6) AS baseline_hits,
               round(b.s / m.users::DOUBLE, 6) AS baseline_hits_all_users, round(m.v - b.v, 6) AS uplift,
               round(coalesce((m.v - b.v) * 100 / nullif(b.v, 0), 0), 6) AS uplift_pct FROM m, b"""
    ),
    "ndcg_at_10": with_features(
        SPLIT
        + """, r AS (SELECT user_key, score, label,
                 row_number() OVER (PARTITION BY user_key ORDER BY score DESC, product_key) AS rk,
                 row_number() OVER (PARTITION BY user_key ORDER BY label DESC, product_key) AS best,
                 count(*) OVER (PARTITION BY user_key) AS rows FROM test_m),
        g AS (SELECT *, avg(CASE WHEN rk <= 10 THEN 1 / log2(rk + 1) ELSE 0 END)
                 OVER (PARTITION BY user_key, score) AS gain FROM r),
        u AS (SELECT user_key, coalesce(sum(label * gain)
                / nullif(sum(CASE WHEN best <= 10 THEN label / log2(best + 1) ELSE 0 END), 0), 0) AS ndcg
              FROM g WHERE rows >= 2 GROUP BY user_key)
        SELECT round(avg(ndcg), 6) AS ndcg, count(*) AS users FROM u"""
    ),
    "rec_order_counts": with_features(REC + "SELECT user_key, n_orders FROM counted"),
    "rec_routing": with_features(REC + "SELECT user_key, n_orders, route FROM routed"),
    "rec_cold_personal": with_features(
        REC
        + "SELECT p.user_key, p.rank, p.product_key, p.probability, d.product_name FROM personal p"
        " LEFT JOIN dim_product d USING (product_key)"
    ),
    "rec_global_top": with_features(
        REC + "SELECT g.*, d.product_name FROM global_top g LEFT JOIN dim_product d USING (product_key)"
    ),
    "rec_product_features": with_features(
        REC + f"SELECT {columns([c for c in _SCORING if c == 'product_key' or c.startswith(('product_', 'p_'))])} FROM cat_features"
    ),
    "rec_scoring_matrix": with_features(REC + f"SELECT {columns(_SCORING)} FROM scoring"),
    "rec_rule_topk": with_features(
        REC + "SELECT user_key, rank, product_key, round(probability, 6) AS probability FROM rule_top"
    ),
    "rec_batch": with_features(REC + _BATCH),
    "rec_model_batch": with_features(
        REC
        + _BATCH.replace("SELECT f.user_key, f.rank", ", flat AS (SELECT f.user_key, f.rank", 1)
        + ") SELECT cold_start, error, count(DISTINCT user_key) AS users, count(*) AS rows FROM flat GROUP BY ALL"
    ),
    "fe_preprocess": with_features(
        SPLIT
        + """, med AS (SELECT median(up_avg_days_between_orders) AS m FROM train_m)
        SELECT user_key, product_key, round(coalesce(up_avg_days_between_orders, m), 6) AS up_avg_days_between_orders,
               round(up_days_since_last - coalesce(up_avg_days_between_orders, m), 6) AS up_delta_days,
               CASE WHEN up_avg_days_between_orders IS NULL THEN 1 ELSE 0 END::BIGINT AS up_avg_days_between_orders_missing
        FROM matrix, med"""
    ),
}
