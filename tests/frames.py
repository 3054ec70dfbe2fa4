"""Small hand-built and synthetic frames shared by the tests."""

import random

FACT = (
    "order_key long, user_key long, product_key long, order_dow int, order_hour_of_day int,"
    " days_since_prior_order double, add_to_cart_order int, reordered int, order_number int, get_eval string"
)


def fact_rows(spark, rows):
    """rows: (user, order_number, product, days, eval[, cart, reordered]); order key = user*1000+number."""
    full = []
    for user, number, product, days, kind, *rest in rows:
        cart, reordered = (rest + [1, 0])[:2] if rest else (1, 0)
        full.append((user * 1000 + number, user, product, 1, 10, days, cart, reordered, number, kind))
    return spark.createDataFrame(full, FACT)


def dim_product(spark, products, departments=3, aisles=5):
    return spark.createDataFrame(
        [(p, f"product {p}", f"aisle {p % aisles}", f"department {p % departments}") for p in products],
        "product_key long, product_name string, aisle_name string, department_name string",
    )


def synthetic_star(spark, users=40, orders=4, per_order=4, catalogue=20, seed=7):
    """Users with prior orders and one train order of two products they have bought."""
    draw = random.Random(seed)
    rows = []
    for user in range(1, users + 1):
        seen = {}
        for number in range(1, orders + 1):
            days = None if number == 1 else float(draw.randint(1, 29))
            for cart, product in enumerate(draw.sample(range(1, catalogue + 1), per_order), start=1):
                rows.append((user, number, product, days, "prior", cart, int(product in seen)))
                seen.setdefault(product, number)
        for cart, product in enumerate(draw.sample(sorted(seen), 2), start=1):
            rows.append((user, orders + 1, product, float(draw.randint(1, 29)), "train", cart, 1))
    return fact_rows(spark, rows), dim_product(spark, range(1, catalogue + 1))
