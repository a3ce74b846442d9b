"""Saved models (S5) and scoring of a stream with them (ST3).

A bundle holds all that scoring needs: the fitted feature state, the severity stack, the duration
model, the closure model with its threshold.  Each version is a folder of parquet tables and Spark
ML pipelines; a version counts once its line stands in the manifest, which is written last, so
readers never see half of one and a save that is repeated replaces itself.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT, EngineConfig
from roadpulse.operators.boosting import BoostParams, HistBoost, Objective, OrderedBoost, OrderedStatistics, Tree
from roadpulse.operators.models import ClosureModel, DurationBoost, DurationModel, ModelParams, SeverityStack, score_incidents
from roadpulse.operators.state import FeatureModel


def _put(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").parquet(path)


def _get(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["value"])


def save_boost(model: HistBoost, spark: SparkSession, path: str) -> None:
    """Trees as a table, one row each; bins and objectives as text."""
    rows = [
        (m, t, *[getattr(tree, c).tolist() for c in ("feature", "bin", "value", "gain")])
        for m, own in enumerate(model.trees) for t, tree in enumerate(own)
    ]
    schema = "model int, tree int, feature array<long>, bin array<long>, value array<double>, gain array<double>"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/trees")
    objectives = [asdict(o) for o in model.objectives]
    _put(spark, f"{path}/about", {"features": model.features, "max_bin": model.max_bin, "objectives": objectives,
                                  "edges": [e.tolist() for e in model.edges], "starts": model.starts.tolist()})


def load_boost(spark: SparkSession, path: str) -> HistBoost:
    about = _get(spark, f"{path}/about")
    objectives = [Objective(**(o | {"params": BoostParams(**o["params"])})) for o in about["objectives"]]
    model = HistBoost(about["features"], objectives, about["max_bin"])
    model.edges, model.starts = [np.array(e, float) for e in about["edges"]], np.array(about["starts"])
    model.trees = [[] for _ in objectives]
    for r in spark.read.parquet(f"{path}/trees").orderBy("model", "tree").collect():  # bounded by the models' sizes
        model.trees[r["model"]].append(Tree(np.array(r["feature"]), np.array(r["bin"]), np.array(r["value"]), np.array(r["gain"])))
    return model


def save_severity(model: SeverityStack, spark: SparkSession, path: str) -> None:
    for name, base in model.bases:
        base.write().overwrite().save(f"{path}/{name}")
    model.meta.write().overwrite().save(f"{path}/meta")
    about = {"features": model.features, "label": model.label, "params": asdict(model.p), "categories": model.categories, "ordered": asdict(model.ordered),
             "bases": [n for n, _ in model.bases]}
    if model.more:
        statistics = model.more.statistics
        save_boost(model.more.model, spark, f"{path}/ordered")
        statistics.state.write.mode("overwrite").parquet(f"{path}/ordered/state")
        about |= {"prior": statistics.prior, "weight": statistics.weight}
    _put(spark, f"{path}/about", about)


def load_severity(spark: SparkSession, path: str) -> SeverityStack:
    about = _get(spark, f"{path}/about")
    model = SeverityStack(about["features"], about["label"], ModelParams(**about["params"]), about["categories"], BoostParams(**about["ordered"]))
    model.bases = [(n, PipelineModel.load(f"{path}/{n}")) for n in about["bases"]]
    model.meta, model.more = PipelineModel.load(f"{path}/meta"), None
    if "prior" in about:
        model.more = OrderedBoost(about["features"], about["categories"], about["label"], model.ordered)
        model.more.model = load_boost(spark, f"{path}/ordered")
        state = spark.read.parquet(f"{path}/ordered/state")
        model.more.statistics = OrderedStatistics(about["categories"], state, about["prior"], about["weight"])
    return model


def save_duration(model: DurationModel | DurationBoost, spark: SparkSession, path: str) -> None:
    if isinstance(model, DurationBoost):
        save_boost(model.model, spark, f"{path}/boost")
        _put(spark, f"{path}/about", {"kind": "boost", "features": model.features, "target": model.target, "params": asdict(model.p), "max_bin": model.max_bin})
        return
    model.forest.write().overwrite().save(f"{path}/forest")
    model.mean_model.write().overwrite().save(f"{path}/mean")
    model.leaf_quantiles.write.mode("overwrite").parquet(f"{path}/leaves")
    _put(spark, f"{path}/about", {"kind": "forest", "features": model.features, "target": model.target, "params": asdict(model.p)})


def load_duration(spark: SparkSession, path: str) -> DurationModel | DurationBoost:
    about = _get(spark, f"{path}/about")
    if about["kind"] == "boost":
        model = DurationBoost(about["features"], about["target"], BoostParams(**about["params"]), about["max_bin"])
        model.model = load_boost(spark, f"{path}/boost")
        return model
    model = DurationModel(about["features"], about["target"], ModelParams(**about["params"]))
    model.forest, model.mean_model = PipelineModel.load(f"{path}/forest"), PipelineModel.load(f"{path}/mean")
    model.leaf_quantiles = spark.read.parquet(f"{path}/leaves")
    return model


def save_closure(model: ClosureModel, spark: SparkSession, path: str) -> None:
    model.model.write().overwrite().save(f"{path}/model")
    _put(spark, f"{path}/about", {"features": model.features, "label": model.label, "params": asdict(model.p), "threshold": model.threshold})


def load_closure(spark: SparkSession, path: str) -> ClosureModel:
    about = _get(spark, f"{path}/about")
    model = ClosureModel(about["features"], about["label"], ModelParams(**about["params"]))
    model.model, model.threshold = PipelineModel.load(f"{path}/model"), about["threshold"]
    return model


@dataclass
class ModelBundle:
    features: FeatureModel
    severity: SeverityStack
    duration: DurationModel | DurationBoost
    closure: ClosureModel

    def score(self, clean: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """M8 from clean incidents: features with the fitted state (and earlier incidents), then all three models."""
        return score_incidents(self.features.transform(clean, history), self.severity, self.duration, self.closure)

    def save(self, spark: SparkSession, path: str, version: int) -> None:
        own = f"{path}/v{version}"
        self.features.save(f"{own}/features")
        save_severity(self.severity, spark, f"{own}/severity")
        save_duration(self.duration, spark, f"{own}/duration")
        save_closure(self.closure, spark, f"{own}/closure")
        line = spark.createDataFrame([(version,)], "version int").withColumn("saved_at", F.current_timestamp())
        line.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v{version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None, cfg: EngineConfig = DEFAULT) -> "ModelBundle":
        own = f"{path}/v{latest_version(spark, path) if version is None else version}"
        return cls(FeatureModel.load(spark, f"{own}/features", cfg), load_severity(spark, f"{own}/severity"),
                   load_duration(spark, f"{own}/duration"), load_closure(spark, f"{own}/closure"))


def latest_version(spark: SparkSession, path: str) -> int:
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/manifest").agg(F.max("version")).first()[0]


class BundleScorer:
    """Scores micro-batches with the newest saved version, looked up before each of them."""

    def __init__(self, spark: SparkSession, path: str, history: DataFrame | None = None):
        self.spark, self.path, self.history = spark, path, history
        self.version, self.bundle = None, None

    def __call__(self, batch: DataFrame) -> DataFrame:
        newest = latest_version(self.spark, self.path)
        if newest != self.version:
            self.version, self.bundle = newest, ModelBundle.load(self.spark, self.path, newest)
        return self.bundle.score(batch, self.history).withColumn("model_version", F.lit(newest))
