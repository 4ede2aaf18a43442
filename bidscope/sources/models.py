"""Model store and registry.

Layout: ``root/market=<m>/clf=<c>/ts=<t>/<id>/{model, minima, features, meta}`` plus
the registry, a log of manifests in ``root/_registry`` (``sources.manifests``): each
lists every saved model, one line each, and is committed after the model's files are
complete.  Writers may run at once: one whose commit comes second starts again from the
other's, so both are registered, and a reader never sees half a model.  The newest
model per (market, classifier) is chosen with a window over the registry.

Spark ML models are stored as a ``PipelineModel`` with their assembler;
AdaBoost as a table of stumps, forests and boosted trees as one of nodes; RBF-SVM as a table of its random features and
two models; 3-NN as its training points.
"""

from __future__ import annotations

import json
import time
import uuid

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.operators.boosting import BoostedTreesModel
from bidscope.operators.forest import RandomForestModel
from bidscope.operators.models import AdaBoostModel, NearestNeighboursModel, RbfSvmModel, retrain
from bidscope.schema import ALL_CLASSIFIERS
from bidscope.sources.manifests import ManifestLog

TREE = "tree int, node int, feature int, threshold double, value double"
FOREST = "tree int, node int, feature int, threshold double, left int, share double, n double, gain double"
STUMP = "position int, feature int, threshold double, left double, right double, alpha double"


def model_dir(root: str, market: str, clf: int, ts: int) -> str:
    """A new folder for a model; writers of one millisecond do not share it."""
    return f"{root}/market={market}/clf={clf}/ts={ts}/{uuid.uuid4().hex[:12]}"


def _write_model(spark: SparkSession, model, features: list[str], path: str) -> str:
    """Write the model under ``path``; returns its kind."""
    if isinstance(model, AdaBoostModel):
        rows = [(i, *s) for i, s in enumerate(model.stumps)]
        spark.createDataFrame(rows, STUMP).write.parquet(path)
        return "adaboost"
    if isinstance(model, BoostedTreesModel):
        spark.createDataFrame(model.rows, TREE).write.parquet(path)
        return "boosted_trees"
    if isinstance(model, RandomForestModel):
        spark.createDataFrame(model.rows, FOREST).write.parquet(path)
        return "forest"
    if isinstance(model, RbfSvmModel):
        rows = [(i, [float(x) for x in w], float(b)) for i, (w, b) in enumerate(zip(model.w, model.b))]
        spark.createDataFrame(rows, "position int, w array<double>, b double").write.parquet(f"{path}/random")
        model.svc.save(f"{path}/svc")
        model.platt.save(f"{path}/platt")
        return "rbf_svm"
    if isinstance(model, NearestNeighboursModel):
        model.points.withColumn("k", F.lit(model.k)).write.parquet(path)
        return "nearest"
    if isinstance(model, MLWritable):
        assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
        PipelineModel([assembler, model]).save(path)
        return "pipeline"
    raise TypeError(f"no stored form for {type(model).__name__}")


def _read_model(spark: SparkSession, kind: str, path: str):
    if kind == "adaboost":
        rows = spark.read.parquet(path).orderBy("position").collect()       # one row per round
        return AdaBoostModel([tuple(r)[1:] for r in rows])
    if kind == "boosted_trees":
        return BoostedTreesModel(spark.read.parquet(path).orderBy("tree", "node").collect())    # a few rows per tree
    if kind == "forest":
        return RandomForestModel(spark.read.parquet(path).orderBy("tree", "node").collect())    # one row a node
    if kind == "rbf_svm":
        rows = spark.read.parquet(f"{path}/random").orderBy("position").collect()   # one row per random feature
        return RbfSvmModel(np.array([r["w"] for r in rows]), np.array([r["b"] for r in rows]),
                           LinearSVCModel.load(f"{path}/svc"), LogisticRegressionModel.load(f"{path}/platt"))
    if kind == "nearest":
        points = spark.read.parquet(path)
        return NearestNeighboursModel(points.drop("k"), points.first()["k"])
    return PipelineModel.load(path).stages[-1]


def save_model(spark: SparkSession, root: str, market: str, trained: dict,
               minima: DataFrame | None = None, ranking: DataFrame | None = None,
               ts: int | None = None) -> str:
    """S9 + S11: model, product minima and ordered feature list; then its registry row.

    Raises when the model has no stored form; nothing is registered then.
    """
    ts = ts or int(time.time() * 1000)
    path = model_dir(root, market, trained["clf"], ts)
    kind = _write_model(spark, trained["model"], trained["features"], f"{path}/model")
    if minima is not None:
        minima.write.parquet(f"{path}/minima")
    score = {r["FeatureName"]: r["FI"] for r in ranking.collect()} if ranking is not None else {}
    spark.createDataFrame([(i, f, score.get(f)) for i, f in enumerate(trained["features"])],
                          "position int, FeatureName string, FI double").write.parquet(f"{path}/features")
    spark.createDataFrame([(kind, minima is not None)], "kind string, has_minima boolean").write.parquet(f"{path}/meta")
    row = json.dumps([market, int(trained["clf"]), int(ts), path])
    ManifestLog(spark, f"{root}/_registry").update(lambda rows: [*rows, row])
    return path


def model_registry(spark: SparkSession, root: str, market: str | None = None,
                   clf: int = ALL_CLASSIFIERS) -> DataFrame:
    """Newest saved model per (market, classifier); 7 = all."""
    rows = [tuple(json.loads(x)) for x in ManifestLog(spark, f"{root}/_registry").read()]     # one per saved model
    if not rows:
        raise FileNotFoundError(f"no model is registered in {root}")
    reg = spark.createDataFrame(rows, "market string, clf int, ts long, path string")
    if market is not None:
        reg = reg.where(F.col("market") == market)
    if clf != ALL_CLASSIFIERS:
        reg = reg.where(F.col("clf") == clf)
    w = Window.partitionBy("market", "clf").orderBy(F.desc("ts"), F.desc("path"))
    return reg.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def retrain_and_save(spark: SparkSession, root: str, market: str, old: DataFrame, new: DataFrame, clf: int = 1,
                     features: list[str] | None = None, minima: DataFrame | None = None,
                     ranking: DataFrame | None = None) -> tuple[dict, str]:
    """Old and new training data unioned (U3), one fit (M1), saved and registered.
    Returns the model and its folder; it is the market's newest from then on."""
    trained = retrain(old, new, clf, features)
    return trained, save_model(spark, root, market, trained, minima, ranking)


def load_model(spark: SparkSession, path: str) -> dict:
    """Model, features in order, and minima (None when none were saved)."""
    meta = spark.read.parquet(f"{path}/meta").first()
    feats = [r["FeatureName"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    clf = int(path.rstrip("/").split("/clf=")[1].split("/")[0])
    return {"model": _read_model(spark, meta["kind"], f"{path}/model"), "features": feats, "clf": clf,
            "minima": spark.read.parquet(f"{path}/minima") if meta["has_minima"] else None}
