import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cartlens.operators import train, validate
from cartlens.plans import jobs
from frames import synthetic_star

SMALL = jobs.TrainingConfig(params=train.TreeParams(max_iter=3, max_depth=3, min_instances=1), restarts=2)


@pytest.fixture(scope="module")
def star(spark):
    fact, dim = synthetic_star(spark, users=60, orders=6, per_order=6, catalogue=12)
    return fact, dim


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory, star):
    """Matrix and a fitted model over it."""
    from cartlens.operators import features as fe

    root = str(tmp_path_factory.mktemp("model"))
    matrix = fe.feature_matrix(*star, 2, 1)
    matrix.write.parquet(f"{root}/matrix")
    matrix = spark.read.parquet(f"{root}/matrix")

    def stage(name, frame):
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    return root, matrix, jobs.fit_model(matrix, SMALL, stage), stage


def test_end_to_end_model(run):
    _, matrix, trained, _ = run
    row = trained.test_metrics.first()
    assert all(0 <= row[m] <= 1 for m in ("precision", "recall", "f1", "auc"))
    assert trained.prepared.count() == matrix.count()
    seen = trained.prepared.groupBy("split").agg(F.min("user_cluster"), F.max("user_cluster")).collect()
    by_split = {r.split: (r[1], r[2]) for r in seen}
    # categories are shifted by one for the trees: 0 stands for an unseen user
    assert by_split["test"] == (0, 0) and by_split["val"] == (0, 0)
    assert by_split["train"][0] >= 1 and by_split["train"][1] <= 5
    importance = trained.importance.collect()
    assert len(importance) == len(train.MODEL_FEATURES)
    assert sum(r.importance for r in importance) == pytest.approx(1)


def test_publish_record_rollback_and_kpis(spark, run):
    root, _, trained, stage = run
    record = stage("record", trained.record)
    assert jobs.published_f1(spark, root) is None
    name = jobs.publish_model(trained, record, root)
    f1 = record.first()["metrics_test"]["f1"]
    assert jobs.published_f1(spark, root) == pytest.approx(f1)
    assert spark.read.json(f"{root}/models/latest.json").first()["run"] == name
    again = jobs.cluster.ClusterModel.load(
        spark, f"{root}/models/{name}/user_cluster", "user_key", jobs.USER_CLUSTER_FEATURES
    )
    assert again.centres == trained.clusters[0].centres
    figures = train.kpis(record).first()
    assert figures.total_users == 60 and figures.active_features <= len(train.MODEL_FEATURES)
    assert max(r.share_of_max for r in figures.importance_shares) == 1.0


def test_gates():
    train.rollback_gate(None, 0.1)
    train.rollback_gate(0.4, 0.39)
    with pytest.raises(train.GateError):
        train.rollback_gate(0.4, 0.37)
    assert train.publishable(0.10) and not train.publishable(0.09)


def test_preprocess_recomputes_the_delta(spark):
    from cartlens.schemas import NULLABLE_COLUMNS

    names = ["up_days_since_last", *NULLABLE_COLUMNS]
    rows = [(10.0, 0.5, 0.5, 4.0, 6.0), (7.0, None, 0.1, None, None), (1.0, 0.3, 0.2, 2.0, -1.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    out = train.preprocess(df, train.medians(df)).orderBy(F.desc("up_days_since_last")).collect()
    assert out[1].up_avg_days_between_orders == 3.0 and out[1].up_delta_days == 4.0
    assert out[1].p_department_reorder_rate == 0.4
    assert [r.up_delta_days_missing for r in out] == [0, 1, 0]


def test_best_threshold_is_the_best(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.2)]
    df = spark.createDataFrame(rows, "label int, score double")
    best = train.best_threshold(df).first()
    assert best.threshold == 0.6 and best.f1 == pytest.approx(6 / 7)


def test_search_is_seeded():
    base = train.TreeParams()
    assert train.random_params(3, base, 1) == train.random_params(3, base, 1) != train.random_params(3, base, 2)


def test_gate_blocks_training(spark, star, folder, monkeypatch):
    monkeypatch.setattr(jobs, "fit_model", lambda *a, **k: pytest.fail("must not train"))
    fact, dim = star
    # minimum thresholds leave an empty matrix whose user features fail the gate
    monkeypatch.setattr(
        jobs.features,
        "feature_matrix",
        lambda *a, **k: spark.range(1).select(F.col("id").alias("user_key"), F.lit(2).alias("label")),
    )
    with pytest.raises(validate.GateError):
        jobs.training_job(fact, dim, folder, SMALL)
    assert spark.read.json(f"{folder}/reports/validation").count() > 0


def test_snapshot_and_drift(spark, star, folder, monkeypatch):
    monkeypatch.setattr(jobs, "fit_model", lambda *a, **k: pytest.fail("must not train"))
    fact, dim = star
    assert jobs.drift_job(spark, folder) is None
    assert jobs.snapshot_job(fact, dim, folder, "reference").first().rows >= 0
    with pytest.raises(FileNotFoundError):
        jobs.drift_job(spark, folder)


def test_missing_matrix_is_skipped(spark, folder):
    report = jobs.validation_job(spark, f"{folder}/none", folder).first()
    assert report.check == "skipped" and report.passed


def test_workspace_follows_the_configured_folder(folder):
    """The setting is static, so a session of its own checks it."""
    script = (
        "from pyspark.sql import SparkSession\n"
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{folder}').getOrCreate()\n"
        "from cartlens.plans.workspace import Workspace\n"
        "ws = Workspace(s, '/some/input')\n"
        "print(ws.stage('numbers', s.range(5)).inputFiles()[0].removeprefix('file://'))\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().startswith(folder), done.stderr[-500:]


def test_best_iteration_waits():
    assert train.best_iteration([3.0, 2.0, 2.5, 2.4, 1.0], patience=5) == 5
    assert train.best_iteration([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert train.best_iteration([1.0], patience=1) == 1


def test_a_gap_without_any_value_is_filled(spark):
    rows = spark.createDataFrame(
        [(1.0, None, None, None)],
        "up_days_since_last double, up_avg_days_between_orders double, up_delta_days double, user_days_since_last_order double",
    )
    from cartlens.schemas import NULLABLE_COLUMNS

    rows = rows.withColumns({c: F.lit(None).cast("double") for c in NULLABLE_COLUMNS if c not in rows.columns})
    filled = train.preprocess(rows, train.medians(rows)).first()
    assert filled.up_avg_days_between_orders == 0.0 and filled.up_delta_days == 1.0
    assert filled.up_avg_days_between_orders_missing == 1


def test_a_published_model_scores_the_same_in_a_new_session(spark, run, star):
    root, _, trained, stage = run
    from cartlens.operators import recommend

    jobs.publish_model(trained, stage("record2", trained.record), root)
    fact, dim = star
    prior = fact.where("get_eval = 'prior'")
    users = fact.select("user_key").distinct()
    routed = recommend.routes(users, prior, users)
    scoring = stage("scoring", recommend.scoring_matrix(routed, prior, dim, 1))
    loaded = jobs.load_model(spark.newSession(), root)
    keys = ["user_key", "product_key"]
    one, two = (
        sorted(map(tuple, jobs.score_requests(scoring, m).select(*keys, "score").collect())) for m in (trained, loaded)
    )
    assert one == two and len(one) > 0
    text = prior.withColumn("days_since_prior_order", F.col("days_since_prior_order").cast("string"))
    flat = jobs.recommend_job(users, text, users, dim, root, stage=lambda n, f: stage(f"job_{n}", f))
    assert flat.where("error is null").select("user_key").distinct().count() > 0
    with pytest.raises(FileNotFoundError):
        jobs.load_model(spark, f"{root}/nowhere")


def test_a_failing_file_system_is_an_error(spark):
    from py4j.protocol import Py4JJavaError

    from cartlens.sources import tables

    with pytest.raises(Py4JJavaError):
        tables.path_exists(spark, "nosuchscheme://host/path")


def test_a_failed_publication_keeps_the_old_snapshot(spark, folder):
    from cartlens.sources import sinks

    path = sinks.publish(spark.range(3), folder, "actual")
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.publish(broken, folder, "actual")
    assert spark.read.parquet(path).count() == 3
    sinks.publish(spark.range(5), folder, "actual")
    assert spark.read.parquet(path).count() == 5


def test_two_threads_open_one_workspace(spark):
    from concurrent.futures import ThreadPoolExecutor

    from cartlens.plans.workspace import Workspace

    with ThreadPoolExecutor(8) as pool:
        opened = list(pool.map(lambda _: Workspace.open(spark, "/tmp/none"), range(32)))
    assert len({id(w) for w in opened}) == 1


def test_registered_training_and_search_are_whole(monkeypatch):
    from types import SimpleNamespace

    from cartlens.plans import registry

    asked = []
    monkeypatch.setattr(registry, "_ready", lambda ws: SimpleNamespace(rows=None, coded=None))
    monkeypatch.setattr(train, "search", lambda rows, coded, *a: (None, asked.append(train.random_params(*a))))
    registry._tuned(SimpleNamespace(stage=None))
    assert registry.TRAINING.params == train.TreeParams()
    assert len(asked[0]) == 50 and {p.patience for p in asked[0]} == {30}
    assert min(p.max_iter for p in asked[0]) >= 200 and max(p.max_iter for p in asked[0]) > 900
    assert {p.max_depth for p in asked[0]} == set(range(3, 13))


def test_clusters_do_not_wait_for_trees(monkeypatch):
    from types import SimpleNamespace

    from cartlens.plans import registry

    monkeypatch.setattr(jobs, "fit_model", lambda *a, **k: pytest.fail("must not train"))
    found = jobs.Clustered(None, None, ("users", "products"))
    monkeypatch.setattr(jobs, "fit_clusters", lambda *a: found)
    ws = SimpleNamespace(path="nowhere", matrix=None, stage=None)
    assert registry._clustered(ws) is registry._clustered(ws) is found
