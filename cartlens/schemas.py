"""Table schemas and the constants every operator shares."""

from pyspark.sql import types as T

INT, SHORT, BYTE = T.IntegerType(), T.ShortType(), T.ByteType()
DOUBLE, FLOAT, STRING = T.DoubleType(), T.FloatType(), T.StringType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# --- operational tables -------------------------------------------------------------------------
SOURCE_SCHEMAS = {
    "users": _struct(
        ("user_id", INT, False),
        ("user_name", STRING, True),
        ("user_address", STRING, True),
        ("user_age", INT, True),
    ),
    "aisles": _struct(("aisle_id", INT, False), ("aisle", STRING, False)),
    "departments": _struct(("department_id", INT, False), ("department", STRING, False)),
    "products": _struct(
        ("product_id", INT, False),
        ("product_name", STRING, False),
        ("aisle_id", INT, False),
        ("department_id", INT, False),
    ),
    "orders": _struct(
        ("order_id", INT, False),
        ("user_id", INT, False),
        ("eval_set", STRING, False),
        ("order_number", INT, False),
        ("order_dow", INT, False),
        ("order_hour_of_day", STRING, False),
        ("days_since_prior_order", DOUBLE, True),
    ),
    "order_products": _struct(
        ("order_id", INT, False),
        ("product_id", INT, False),
        ("add_to_cart_order", INT, False),
        ("reordered", INT, False),
    ),
}

# Load order of the operational files: dimensions before facts.
LOAD_ORDER = (
    ("users", "users"),
    ("aisles", "aisles"),
    ("departments", "departments"),
    ("products", "products"),
    ("orders", "orders"),
    ("order_products_prior", "order_products"),
    ("order_products_train", "order_products"),
)

# --- star schema --------------------------------------------------------------------------------
DIM_USER = _struct(
    ("user_key", INT, False),
    ("user_name", STRING, True),
    ("user_address", STRING, True),
    ("user_birthdate", T.DateType(), True),
)
DIM_PRODUCT = _struct(
    ("product_key", INT, False),
    ("product_name", STRING, False),
    ("aisle_name", STRING, False),
    ("department_name", STRING, False),
)
FACT = _struct(
    ("order_key", INT, False),
    ("user_key", INT, False),
    ("product_key", INT, False),
    ("order_dow", SHORT, False),
    ("order_hour_of_day", SHORT, False),
    ("days_since_prior_order", DOUBLE, True),
    ("add_to_cart_order", SHORT, False),
    ("reordered", SHORT, False),
    ("order_number", INT, False),
    ("get_eval", STRING, False),
)
STAR_SCHEMAS = {"dim_user": DIM_USER, "dim_product": DIM_PRODUCT, "fact_order_products": FACT}
# Primary keys, references (column to table), longest texts and value rules of the star schema.
STAR_KEYS = {
    "dim_user": ["user_key"],
    "dim_product": ["product_key"],
    "fact_order_products": ["order_key", "product_key"],
}
STAR_REFERENCES = {"fact_order_products": {"user_key": "dim_user", "product_key": "dim_product"}}
STAR_LENGTHS = {
    "dim_user": {"user_name": 150, "user_address": 300},
    "dim_product": {"product_name": 300, "aisle_name": 100, "department_name": 100},
    "fact_order_products": {"get_eval": 10},
}
STAR_RULES = {"fact_order_products": {"get_eval": "get_eval in ('train', 'prior')"}}

# --- feature matrix: fixed column contract ------------------------------------------------------
MATRIX = _struct(
    ("user_key", INT, False),
    ("product_key", INT, False),
    ("user_total_orders", SHORT, False),
    ("user_avg_basket_size", FLOAT, False),
    ("user_days_since_last_order", FLOAT, False),
    ("user_reorder_ratio", FLOAT, False),
    ("user_distinct_products", INT, False),
    ("user_segment_code", BYTE, False),
    ("product_total_purchases", INT, False),
    ("product_reorder_rate", FLOAT, False),
    ("product_avg_add_to_cart", FLOAT, False),
    ("product_unique_users", INT, False),
    ("p_department_reorder_rate", FLOAT, True),
    ("p_aisle_reorder_rate", FLOAT, True),
    ("up_times_purchased", SHORT, False),
    ("up_reorder_rate", FLOAT, False),
    ("up_orders_since_last_purchase", SHORT, False),
    ("up_first_order_number", SHORT, False),
    ("up_last_order_number", SHORT, False),
    ("up_avg_add_to_cart_order", FLOAT, False),
    ("up_days_since_last", FLOAT, False),
    ("up_avg_days_between_orders", FLOAT, True),
    ("up_delta_days", FLOAT, True),
    ("u_favorite_department", BYTE, False),
    ("u_favorite_aisle", SHORT, False),
    ("label", BYTE, False),
)
MATRIX_COLUMNS = [f.name for f in MATRIX.fields]
NULLABLE_COLUMNS = [f.name for f in MATRIX.fields if f.nullable]
REQUIRED_COLUMNS = [f.name for f in MATRIX.fields if not f.nullable]
FEATURE_COLUMNS = [c for c in MATRIX_COLUMNS if c not in ("user_key", "product_key", "label")]
RATE_COLUMNS = [c for c in MATRIX_COLUMNS if c.endswith(("_rate", "_ratio"))]

# --- fixed values -------------------------------------------------------------------------------
MIN_USER_ORDERS = 5
MIN_PRODUCT_ORDERS = 50
SEGMENT_EDGES = (0, 5, 10, 20, 40)
SEGMENT_UPPER = 101
SEGMENT_NAMES = {1: "Esporádico", 2: "Ocasional", 3: "Regular", 4: "Frecuente", 5: "Power User"}
DAY_NAMES = {
    0: "Domingo",
    1: "Lunes",
    2: "Martes",
    3: "Miercoles",
    4: "Jueves",
    5: "Viernes",
    6: "Sabado",
}

MONITORED_FEATURES = (
    "user_total_orders",
    "user_avg_basket_size",
    "user_reorder_ratio",
    "product_total_purchases",
    "product_reorder_rate",
    "up_times_purchased",
    "up_reorder_rate",
    "up_days_since_last",
)
USER_CLUSTER_FEATURES = (
    "user_total_orders",
    "user_avg_basket_size",
    "user_days_since_last_order",
    "user_reorder_ratio",
    "user_distinct_products",
)
PRODUCT_CLUSTER_FEATURES = (
    "product_total_purchases",
    "product_reorder_rate",
    "product_avg_add_to_cart",
    "product_unique_users",
    "p_department_reorder_rate",
)
CATEGORICAL_FEATURES = (
    "user_segment_code",
    "u_favorite_department",
    "u_favorite_aisle",
    "user_cluster",
    "product_cluster",
)
