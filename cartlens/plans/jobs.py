"""Jobs: full training, weekly snapshot, drift check and batch recommendation."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlens.operators import cluster, drift, features, metrics, recommend, split, train, validate
from cartlens.functions.staging import Stage, unstaged
from cartlens.operators.boosting import Ensemble
from cartlens.schemas import MATRIX, PRODUCT_CLUSTER_FEATURES, USER_CLUSTER_FEATURES
from cartlens.functions.columns import narrow
from cartlens.sources import sinks, tables


@dataclass(frozen=True)
class TrainingConfig:
    """Parameters of a training run."""

    params: train.TreeParams = field(default_factory=train.TreeParams)
    trials: int = 0
    restarts: int = cluster.RESTARTS
    seed: int = 42
    threshold: float = 0.5


@dataclass(frozen=True)
class Trained:
    """A fitted model with everything needed to score and to report."""

    model: Ensemble
    clusters: tuple[cluster.ClusterModel, cluster.ClusterModel]
    medians: DataFrame
    prepared: DataFrame
    splits: DataFrame
    params: train.TreeParams
    trials: DataFrame | None
    weight: float
    threshold: float

    def scored(self, name: str) -> DataFrame:
        return train.score(self.model, self.prepared.where(F.col("split") == name))

    @property
    def test_metrics(self) -> DataFrame:
        return metrics.evaluate(self.scored("test"), self.threshold)

    @property
    def importance(self) -> DataFrame:
        return train.feature_importance(self.prepared, self.model)

    @property
    def record(self) -> DataFrame:
        return train.model_record(
            self.test_metrics,
            split.split_sizes(self.prepared.drop("split"), self.splits),
            self.importance,
            self.params,
            self.weight,
            train.MODEL_FEATURES,
        )


@dataclass(frozen=True)
class Clustered:
    """Matrix rows with their split, and the clusters of the train rows: what comes before any tree."""

    splits: DataFrame
    rows: DataFrame
    clusters: tuple[cluster.ClusterModel, cluster.ClusterModel]

    @property
    def assigned(self) -> DataFrame:
        """Rows with the clusters of their user and product, assigned per split."""
        rows = self.rows
        for model in self.clusters:
            rows = assign_by_split(model, rows)
        return rows


def fit_clusters(matrix: DataFrame, config: TrainingConfig, stage: Stage = unstaged) -> Clustered:
    """Split by user and cluster the train profiles."""
    splits = stage("model_split", split.split_users(matrix, config.seed))
    rows = stage("model_rows", split.with_split(matrix, splits, config.seed))
    learn = rows.where(F.col("split") == "train")
    clusters = tuple(
        cluster.fit(learn, key, names, seed=config.seed, restarts=config.restarts, stage=stage)
        for key, names in (("user_key", USER_CLUSTER_FEATURES), ("product_key", PRODUCT_CLUSTER_FEATURES))
    )
    return Clustered(splits, rows, clusters)


@dataclass(frozen=True)
class Prepared:
    """Rows ready for the learner, and the same rows in bins."""

    medians: DataFrame
    rows: DataFrame
    weight: float
    coded: train.Coded


def prepare(matrix: DataFrame, clustered: Clustered, stage: Stage = unstaged) -> Prepared:
    """Assign clusters, fill gaps with train medians, and code the features."""
    median_rows = stage("model_medians", train.medians(clustered.rows.where(F.col("split") == "train")))
    rows = stage("model_frame", train.with_codes(train.preprocess(clustered.assigned, median_rows)))
    weight = split.class_weight(matrix).first()["scale_pos_weight"] or 1.0
    return Prepared(median_rows, rows, weight, train.code(rows, weight, stage=stage))


def fit_model(
    matrix: DataFrame,
    config: TrainingConfig,
    stage: Stage = unstaged,
    clustered: Clustered | None = None,
    prepared: Prepared | None = None,
) -> Trained:
    """Split, cluster, prepare and fit; the first steps are taken over where they are given."""
    clustered = clustered or fit_clusters(matrix, config, stage)
    ready = prepared or prepare(matrix, clustered, stage)
    params, trials = config.params, None
    if config.trials:
        params, trials = train.search(ready.rows, ready.coded, config.trials, config.params, config.seed)
    fitted = train.fit_trees(ready.coded, params)
    return Trained(
        fitted, clustered.clusters, ready.medians, ready.rows, clustered.splits, params, trials, ready.weight, config.threshold
    )


def assign_by_split(model: cluster.ClusterModel, rows: DataFrame) -> DataFrame:
    """Assign clusters per split, as each split is profiled on its own rows.

    Splits are by user, so no user of validation or test is in the train profiles: they are unseen without a look.
    """
    names = ("train", "val", "test")
    parts = [rows.where(F.col("split") == name) for name in names]
    if model.key == "user_key":
        held_out = rows.where(F.col("split") != "train").withColumn(model.column, F.lit(cluster.UNSEEN))
        return cluster.assign(model, parts[0]).unionByName(held_out)
    one, two, three = (cluster.assign(model, part) for part in parts)
    return one.unionByName(two).unionByName(three)


def snapshot_job(
    fact: DataFrame, dim_product: DataFrame, root: str, kind: str = "actual", stage: Stage = unstaged
) -> DataFrame:
    """Build and publish the matrix without training; returns its summary."""
    matrix = features.feature_matrix(fact, dim_product, stage=stage)
    path = sinks.publish(matrix, root, kind)
    return features.matrix_summary(fact.sparkSession.read.parquet(path))


def drift_job(spark: SparkSession, root: str, stage: Stage = unstaged) -> DataFrame | None:
    """Compare the published current matrix with the reference.

    Without a reference there is nothing to compare and the result is None; without a current
    snapshot the job fails.
    """
    keys = {"reference": "reference/feature_matrix", "actual": "monitoring/actual/feature_matrix"}
    if not tables.path_exists(spark, f"{root}/{keys['reference']}"):
        return None
    current = tables.read_parquet(spark, f"{root}/{keys['actual']}")
    reference = spark.read.parquet(f"{root}/{keys['reference']}")
    by_feature = stage("drift_by_feature", drift.drift_by_feature(reference, current, stage=stage))
    sinks.write_json(drift.drift_report(by_feature), f"{root}/reports/drift")
    return drift.drift_report(by_feature)


def validation_job(spark: SparkSession, path: str, reports: str) -> DataFrame:
    """Validate a written matrix; a missing one is reported as skipped and passes."""
    if not tables.path_exists(spark, path):
        report = spark.createDataFrame(
            [("skipped", True, f"no matrix at {path}")], "check string, passed boolean, detail string"
        )
    else:
        report = validate.validate(spark.read.parquet(path))
    sinks.write_json(report, f"{reports}/validation")
    return report


def published_f1(spark: SparkSession, root: str) -> float | None:
    """F1 of the latest published model; None without one or when its record is unreadable."""
    latest = f"{root}/models/latest.json"
    if not tables.path_exists(spark, latest):
        return None
    try:
        run = spark.read.json(latest).first()["run"]
        return float(spark.read.json(f"{root}/models/{run}/record").first()["metrics_test"]["f1"])
    except (AnalysisException, KeyError, TypeError, ValueError):
        return None  # the record is missing or unreadable; any other failure must not switch the gate off


def publish_model(trained: Trained, record: DataFrame, root: str, run: str | None = None) -> str:
    """Save under a new run folder, then move the ``latest`` pointer to it."""
    run = run or uuid.uuid4().hex
    folder = f"{root}/models/{run}"
    trained.model.save(record.sparkSession, f"{folder}/model")
    for model in trained.clusters:
        model.save(f"{folder}/{model.column}")
    trained.medians.write.mode("overwrite").parquet(f"{folder}/medians")
    sinks.write_json(record, f"{folder}/record")
    spark = record.sparkSession
    sinks.write_json(spark.createDataFrame([(run,)], "run string"), f"{root}/models/latest.json")
    return run


@dataclass(frozen=True)
class Published:
    """What scoring needs of a published model."""

    model: Ensemble
    clusters: tuple[cluster.ClusterModel, cluster.ClusterModel]
    medians: DataFrame


def load_model(spark: SparkSession, root: str) -> Published:
    """The model that the ``latest`` pointer names; without one ``FileNotFoundError``."""
    latest = f"{root}/models/latest.json"
    if not tables.path_exists(spark, latest):
        raise FileNotFoundError(latest)
    folder = f"{root}/models/{spark.read.json(latest).first()['run']}"
    clusters = tuple(
        cluster.ClusterModel.load(spark, f"{folder}/{key.replace('_key', '_cluster')}", key, names)
        for key, names in (("user_key", USER_CLUSTER_FEATURES), ("product_key", PRODUCT_CLUSTER_FEATURES))
    )
    return Published(Ensemble.load(spark, f"{folder}/model"), clusters, spark.read.parquet(f"{folder}/medians"))


def recommend_job(
    requests: DataFrame,
    history: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    root: str,
    k: int = recommend.TOP_K,
    stage: Stage = unstaged,
) -> DataFrame:
    """Recommendations of the requested users with the published model.

    Users with enough history are scored by the model, those with less get their own or the global
    favourites, and failures are rows with an error text.
    """
    published = load_model(requests.sparkSession, root)
    prior = recommend.coerce_history(history)
    routed = stage("routed", recommend.routes(requests, prior, dim_user))
    scoring = stage("scoring", recommend.scoring_matrix(routed, prior, dim_product, stage=stage))
    scored = stage("scored", score_requests(scoring, published))
    return recommend.batch(routed, prior, dim_product, scored, k)


def training_job(
    fact: DataFrame, dim_product: DataFrame, root: str, config: TrainingConfig, stage: Stage = unstaged
) -> DataFrame:
    """Features, gate, training, rollback and quality gates, publication of model and reference."""
    spark = fact.sparkSession
    features.check_leakage(features.prior_rows(fact), features.train_rows(fact))
    matrix = stage("training_matrix", features.feature_matrix(fact, dim_product, stage=stage))
    report = validate.validate(matrix)
    sinks.write_json(report, f"{root}/reports/validation")
    validate.gate(report)

    trained = fit_model(matrix, config, stage)
    record = stage("model_record", trained.record)
    new_f1 = record.first()["metrics_test"]["f1"]
    train.rollback_gate(published_f1(spark, root), new_f1)
    published = train.publishable(new_f1)
    if published:
        publish_model(trained, record, root)
        sinks.publish(narrow(matrix, MATRIX), root, "reference")
    return record.select(
        F.col("metrics_test.precision").alias("precision"),
        F.col("metrics_test.recall").alias("recall"),
        F.col("metrics_test.f1").alias("f1"),
        F.col("metrics_test.auc").alias("auc"),
        F.lit(published).alias("published"),
    )


def score_requests(scoring: DataFrame, trained: Trained | Published) -> DataFrame:
    """Model scores of a scoring matrix: clusters, imputation, contract check, prediction."""
    assigned = scoring
    for model in trained.clusters:
        assigned = cluster.assign(model, assigned)
    filled = train.preprocess(assigned, trained.medians)
    aligned = recommend.align(filled, list(train.MODEL_FEATURES), len(trained.model.bins.features))
    return train.score(trained.model, train.with_codes(aligned)).select("user_key", "product_key", "score")


def write_recommendations(flat: DataFrame, path: str) -> None:
    """Write one JSON record per user."""
    recommend.as_records(flat).write.mode("overwrite").json(path)


def record_text(record: DataFrame) -> str:
    """A model record as indented JSON text (one row)."""
    return json.dumps(json.loads(record.toJSON().first()), indent=2, ensure_ascii=False)
