import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.operators import eda, metrics, split

SCHEMA = "user_key long, product_key long, label int, score double, product_total_purchases long"


def scored(spark, seed=3, users=25):
    draw = random.Random(seed)
    rows = [
        (u, p, int(draw.random() < 0.3), draw.randint(0, 6) / 6, 100 - p)
        for u in range(users)
        for p in range(draw.randint(1, 30))
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_auc_counts_ties_half(spark):
    rows, df = scored(spark)
    pos, neg = [r[3] for r in rows if r[2]], [r[3] for r in rows if not r[2]]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert metrics.auc(df).first().auc == pytest.approx(wins / len(pos) / len(neg))


def test_confusion_and_zero_division(spark):
    _, df = scored(spark)
    none = metrics.confusion(df, F.lit(False)).first()
    assert (none.tp, none.fp, none.precision, none.recall, none.f1) == (0, 0, 0.0, 0.0, 0.0)
    everything = metrics.confusion(df, F.lit(True)).first()
    assert everything.recall == 1.0 and everything.fn == 0


def ndcg_user(rows, k):
    gains = [0.0] * len(rows)
    ordered = sorted(rows, key=lambda r: -r[3])
    i = 0
    while i < len(ordered):
        j = i
        while j < len(ordered) and ordered[j][3] == ordered[i][3]:
            j += 1
        share = sum(1 / math.log2(r + 2) for r in range(i, j) if r < k) / (j - i)
        for t in range(i, j):
            gains[t] = ordered[t][2] * share
        i = j
    ideal = sum(1 / math.log2(r + 2) for r in range(min(k, sum(r[2] for r in rows))))
    return sum(gains) / ideal if ideal else 0.0


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ndcg_shares_gain_between_ties(spark, k):
    rows, df = scored(spark)
    got = {r.user_key: r.ndcg for r in metrics.ndcg_per_user(df, k).collect()}
    by_user = {}
    for row in rows:
        by_user.setdefault(row[0], []).append(row)
    expected = {u: ndcg_user(v, k) for u, v in by_user.items() if len(v) >= 2}
    assert got.keys() == expected.keys()
    for user, value in expected.items():
        assert got[user] == pytest.approx(value)
        assert 0 <= got[user] <= 1 + 1e-12


def test_top_k_is_sorted_and_capped(spark):
    _, df = scored(spark)
    rows = metrics.top_k_per_user(df, 5).collect()
    by_user = {}
    for r in sorted(rows, key=lambda r: (r.user_key, r.rank)):
        by_user.setdefault(r.user_key, []).append(r)
    for part in by_user.values():
        assert [r.rank for r in part] == list(range(1, len(part) + 1)) and len(part) <= 5
        assert [r.score for r in part] == sorted((r.score for r in part), reverse=True)


def test_uplift_denominators(spark):
    rows = [(1, 1, 1, 0.9, 5), (1, 2, 0, 0.1, 9), (2, 2, 0, 0.8, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    popular = spark.createDataFrame([(1, 1.0)], "product_key long, popularity double")
    out = metrics.uplift(df, popular, k=1).first()
    assert out.model_hits == 0.5 and out.baseline_hits == 1.0 and out.baseline_hits_all_users == 0.5
    assert out.uplift_pct == -50.0


def test_split_sizes_and_disjoint_users(spark):
    df = spark.range(200).select((F.col("id") % 100).alias("user_key"))
    users = split.split_users(df)
    sizes = {r.split: r.users for r in split.split_sizes(df, users).collect()}
    assert sizes == {"train": 70, "val": 15, "test": 15}
    assert users.count() == users.select("user_key").distinct().count() == 100


def test_scaling_uses_population_deviation_and_median_fill(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 2.0), (3, None, 2.0)], "user_key long, a double, b double")
    stats = split.profile_stats(df, ["a", "b"])
    rows = {r.user_key: r for r in split.scaled_profiles(df, "user_key", ["a", "b"], stats).collect()}
    spread = math.sqrt(2 / 3)
    assert [rows[i].a for i in (1, 2, 3)] == pytest.approx([-1 / spread, 1 / spread, 0.0])
    assert [rows[i].b for i in (1, 2, 3)] == [0.0, 0.0, 0.0]


def test_compare_models_marks_one_best(spark):
    rows = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, f1 double")
    assert {r.model: r.best for r in metrics.compare_models(rows).collect()} == {"a": True, "b": False, "c": False}


def test_split_borders_place_every_user_as_assigned(spark):
    df = spark.range(1, 301).select(F.col("id").alias("user_key"), F.explode(F.array(F.lit(1), F.lit(2))).alias("product_key"))
    for n in (1, 2, 3, 7, 300):
        some = df.where(F.col("user_key") <= n)
        users = split.split_users(some)
        want = {(r.user_key, r.split) for r in users.collect()}
        assert {(r.user_key, r.split) for r in split.with_split(some, users).collect()} == want


def test_pairs_of_a_large_basket_come_from_blocks(spark):
    from collections import Counter
    from itertools import combinations

    from cartlens.operators import eda

    baskets = {1: list(range(40)), 2: [1, 2, 3], 3: [5], 4: [3, 2]}
    lines = spark.createDataFrame([(o, p) for o, ps in baskets.items() for p in ps], "order_id long, product_id long")
    want = Counter(pair for ps in baskets.values() for pair in combinations(sorted(ps), 2))
    for block in (3, 512):
        found = {(r.product_a, r.product_b): r.together for r in eda.pairs_in_baskets(lines, block).collect()}
        assert found == want
    names = spark.createDataFrame([(p, f"p{p}") for p in range(40)], "product_id long, product_name string")
    ranked = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:15]
    for frequent in (2, 10, 100):
        top = eda.co_purchases(lines, names, frequent=frequent, block=7).collect()
        assert sorted(((r.product_a, r.product_b), r.together) for r in top) == sorted(ranked)


def test_correlations_take_complete_rows_of_each_pair(spark):
    draw = np.random.default_rng(3)
    table = draw.normal(5, 2, (700, 3))
    table[:, 1] += table[:, 0]
    gaps = draw.random((700, 3)) < 0.2
    rows = [tuple(None if g else float(x) for x, g in zip(r, own)) for r, own in zip(table, gaps)]
    frame = spark.createDataFrame(rows, "a double, b double, c double").withColumn("d", F.lit(7.0))
    found = {(r.feature_a, r.feature_b): r.correlation for r in eda.correlations(frame.repartition(3), ["a", "b", "c", "d"]).collect()}
    for (i, a), (j, b) in (((0, "a"), (1, "b")), ((0, "a"), (2, "c")), ((1, "b"), (2, "c"))):
        whole = ~gaps[:, i] & ~gaps[:, j]
        assert found[a, b] == pytest.approx(np.corrcoef(table[whole, i], table[whole, j])[0, 1])
    assert all(found[c, "d"] is None for c in "abc")
    with pytest.raises(ValueError, match="'a'"):
        eda.correlations(frame.withColumn("a", F.lit(float("nan"))), ["a", "b"])


def test_correlations_of_no_rows_are_null(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in eda.correlations(empty, ["a", "b"]).collect()] == [("a", "b", None)]


def test_describe_reads_the_rows_once_and_keeps_columns_without_values(spark):
    rows = [(1.0, 1e9 + 1, None), (1.0, 1e9 + 2, None), (4.0, 1e9 + 4, None), (None, None, None)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    kept = []

    def stage(name, counts):
        kept.append(name)
        return counts.localCheckpoint()

    found = {r["feature"]: r for r in eda.describe(frame, ["a", "b", "c"], (50,), stage=stage).collect()}
    assert kept == ["value_counts"]
    assert (found["a"]["count"], found["a"]["mean"], found["a"]["min"], found["a"]["max"], found["a"]["p50"]) == (3, 2.0, 1.0, 4.0, 1.0)
    assert found["a"]["std"] == pytest.approx(3**0.5)
    assert found["b"]["std"] == pytest.approx((7 / 3) ** 0.5, rel=1e-9)
    assert (found["c"]["count"], found["c"]["mean"], found["c"]["std"], found["c"]["p50"]) == (0, None, None, None)
    single = eda.describe(frame.where("a = 4"), ["a"], (50,)).first()
    assert (single["count"], single["mean"], single["std"]) == (1, 4.0, None)
    assert eda.describe(frame.where("false"), ["a"], (50,)).count() == 0
