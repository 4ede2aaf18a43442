"""Winner models: planted signal, store round trip, sweeps (M1-M12, S9-S11, K3, K5, A11, FP4)."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.operators import models as M
from bidscope.plans.catalog_reprice import FormulaModel
from bidscope.schema import CLASSIFIER_NAMES
from bidscope.sources import models as store


@pytest.fixture(scope="module")
def frame(spark):
    """120 auctions of 4 offers; the winner has the lowest price unless another is fulfilled."""
    rng = np.random.default_rng(3)
    rows = []
    for a in range(120):
        price, fba, noise = rng.uniform(10, 20, 4), rng.integers(0, 2, 4), rng.uniform(0, 1, (4, 2))
        best = int(np.argmin(price - 6 * fba))
        for i in range(4):
            rows.append((1 if i == best else -1, f"p{a % 5}", f"s{i}", f"a{a}", "X" if a % 2 else "Y",
                         float(price[i] - price.min()), float(fba[i]), float(noise[i, 0]), float(noise[i, 1]),
                         int(fba[i]), 0, 0.5))
    return spark.createDataFrame(
        rows, "IsBuyBoxWinner int, ProductId string, SellerId string, CompetitionName string, MarketplaceId string, "
              "gap double, fba double, n1 double, n2 double, IsFulfilledByAmazon int, IsFeaturedMerchant int, "
              "IdealPointCompetition double").cache()


FEATURES = ["gap", "fba", "n1", "n2"]
BASE = ["IsBuyBoxWinner", "CompetitionName", *FEATURES, "IsFulfilledByAmazon", "IsFeaturedMerchant", "IdealPointCompetition"]


def winner_f1(scores):
    return {r["label"]: r["f1"] for r in scores.collect()}[1]


@pytest.mark.parametrize("clf", sorted(CLASSIFIER_NAMES))
def test_planted_signal_and_store_round_trip(spark, frame, clf):
    trained = M.train(frame, clf, FEATURES, max_depth=8)
    _, scores = M.evaluate(trained, frame)
    assert winner_f1(scores) > 0.6                       # always-lose has 0
    root = tempfile.mkdtemp(prefix="bidscope-store-")
    minima = spark.createDataFrame([("p0", 1.5)], "ProductId string, min_landed double")
    path = store.save_model(spark, root, "X", trained, minima if clf == 1 else None, ts=5)
    again = store.load_model(spark, path)
    assert again["features"] == FEATURES and again["clf"] == clf
    assert (again["minima"] is None) == (clf != 1)
    keys = ["CompetitionName", "SellerId"]
    a, b = (M.predict(t, frame).select(*keys, F.round("prob", 9).alias("prob"), "predicted") for t in (trained, again))
    assert a.exceptAll(b).count() == 0 and a.count() == frame.count()
    assert store.model_registry(spark, root, "X", clf).count() == 1


def test_nothing_is_registered_that_cannot_be_stored(spark):
    root = tempfile.mkdtemp(prefix="bidscope-store-")
    with pytest.raises(TypeError):
        store.save_model(spark, root, "X", {"model": FormulaModel(), "features": ["a"], "clf": 0})
    with pytest.raises(Exception):
        store.model_registry(spark, root)


def test_newest_model_wins(spark, frame):
    root = tempfile.mkdtemp(prefix="bidscope-store-")
    trained = M.train(frame, 2, FEATURES)
    paths = [store.save_model(spark, root, "X", trained, ts=t) for t in (1, 3, 2)]
    got = store.model_registry(spark, root).collect()
    assert [(r["ts"], r["path"]) for r in got] == [(3, paths[1])]


def test_one_model_per_market_and_classifier(frame):
    trained = M.train_markets(frame, ["X", "Y", "unknown"], 2, FEATURES)
    assert set(trained) == {("X", 2), ("Y", 2)}
    got = M.evaluate_markets(trained, frame)
    support = {(r["market"], r["label"]): r["support"] for r in got.collect()}
    assert support == {(m, s): n for m in "XY" for s, n in ((1, 60), (-1, 180))}
    assert M.classifiers(7) == [1, 2, 3, 4, 5, 6] and M.classifiers(4) == [4]


def test_importance_ranks_the_signal_first_and_keeps_equal_offers(spark, frame):
    ranked = M.feature_importance(frame.select("IsBuyBoxWinner", "ProductId", "SellerId", "CompetitionName", *FEATURES), max_depth=8)
    assert {r["FeatureName"] for r in ranked.limit(2).collect()} == {"gap", "fba"}
    rows = [(1, "p", "s", f"a{i // 2}", 0.0) for i in range(40)] + [(-1, "p", "s", "b", 1.0)]
    same = spark.createDataFrame(rows, "IsBuyBoxWinner int, ProductId string, SellerId string, CompetitionName string, x double")
    kept = same.drop("ProductId", "SellerId").dropDuplicates().drop("CompetitionName")
    assert kept.count() == 21 and M.feature_importance(same).count() == 1


def test_sweeps_and_folds(frame):
    test = frame.where(F.pmod(F.xxhash64("CompetitionName"), F.lit(3)) == 0)
    res, best = M.feature_count_sweep(frame, test, ["gap", "fba", "n1"], 2)
    assert res.count() == 3 and best >= 2
    folds = {r["label"]: r for r in M.cross_validate(frame.select(*BASE), 2, 3).collect()}
    assert folds[1]["repeats"] == 3 and folds[1]["mean"] > 0.6 and folds[1]["std"] is not None
    sizes = M.data_size_sweep(frame.select(*BASE), test, 2, (0.5, 0.9))
    assert {r["fraction"] for r in sizes.collect()} == {0.5, 0.9}
    steps = M.ablation(frame, test, ["n1"], ["gap", "fba"], 2).where("label = 1").orderBy("step").collect()
    assert [r["added"] for r in steps] == ["(base)", "gap", "fba"] and steps[2]["f1"] > steps[0]["f1"]


def test_retrain_and_check_features(frame):
    cols = ["IsBuyBoxWinner", "ProductId", "SellerId", "CompetitionName", *FEATURES]
    old, new = (frame.where(F.col("MarketplaceId") == m).select(*cols) for m in "XY")
    _, scores = M.evaluate(M.retrain(old, new, 2, FEATURES), frame)
    assert winner_f1(scores) > 0.6
    ranking, conf, scores = M.check_features(frame.select(*cols, "IsFulfilledByAmazon", "IsFeaturedMerchant", "IdealPointCompetition"),
                                             frame, 2, drop=["n2"])
    assert "n2" not in {r["FeatureName"] for r in ranking.collect()}
    assert conf.agg(F.sum("n")).first()[0] == frame.count() and winner_f1(scores) > 0.5


def test_market_models_cover_every_market_of_the_data(offers):
    from bidscope.plans.catalog_models import market_frame
    markets, frame = market_frame(offers)
    want = {r[0]: r[1] for r in offers.groupBy("MarketplaceId").count().collect()}
    assert markets == sorted(want) and len(markets) > 3
    assert {r[0]: r[1] for r in frame.groupBy("market").count().collect()} == want
    sides = frame.groupBy("CompetitionName").agg(F.count_distinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0 and frame.where("is_test").count() > 0      # scored on auctions not seen


def test_retrain_and_save_registers_the_newest(spark, frame):
    """One call trains on old and new data, stores the model and makes it the market's newest."""
    root = tempfile.mkdtemp(prefix="bidscope-retrain-")
    cols = ["IsBuyBoxWinner", "ProductId", "SellerId", "CompetitionName", *FEATURES]
    old, new = (frame.where(F.col("MarketplaceId") == m).select(*cols) for m in "XY")
    store.save_model(spark, root, "X", M.train(old, 2, FEATURES), ts=1)
    trained, path = store.retrain_and_save(spark, root, "X", old, new, 2, FEATURES)
    assert [r["path"] for r in store.model_registry(spark, root, "X", 2).collect()] == [path]
    back = store.load_model(spark, path)
    assert back["features"] == list(FEATURES) and back["clf"] == 2
    a, b = (M.predict(t, frame).select("prob").toPandas()["prob"].to_numpy() for t in (trained, back))
    assert np.allclose(a, b)


def test_writers_at_once_are_both_registered(spark, frame):
    from concurrent.futures import ThreadPoolExecutor
    root = tempfile.mkdtemp(prefix="bidscope-writers-")
    trained = M.train(frame, 2, FEATURES)
    with ThreadPoolExecutor(3) as pool:
        paths = list(pool.map(lambda m: store.save_model(spark, root, m, trained, ts=5), "XXYZ"))
    assert len(set(paths)) == 4
    found = {r["market"]: r["path"] for r in store.model_registry(spark, root).collect()}
    assert set(found) == set("XYZ") and set(found.values()) <= set(paths)
    assert all(store.load_model(spark, p)["features"] == list(FEATURES) for p in found.values())


def test_models_of_shared_passes_equal_single_fits(spark, frame, monkeypatch):
    """Coefficients and class scores are those of one fit each; scans do not grow with the models."""
    from bidscope.operators import many
    from bidscope.operators.many import Spec, fit_many, scores_many
    fold = F.pmod(F.xxhash64("CompetitionName"), F.lit(3))
    specs = [Spec(fold != 0), Spec(fold != 1), Spec(F.lit(True), [0, 2]), Spec(F.lit(True))]
    passes, plain = [], many._pass
    monkeypatch.setattr(many, "_pass", lambda *a: passes.append(1) or plain(*a))
    fits = fit_many(frame, FEATURES, specs)
    assert len(passes) == fits[0].iterations + 1 <= 20
    chosen = [frame.where(fold != 0), frame.where(fold != 1), frame, frame]
    for spec, fit, rows in zip(specs, fits, chosen):
        feats = [FEATURES[i] for i in (spec.columns or range(len(FEATURES)))]
        model = M.train(rows, 2, feats)["model"]
        own = [fit.coef[FEATURES.index(c)] for c in feats]
        assert np.allclose(own, model.coefficients.toArray(), rtol=2e-3, atol=2e-3) and abs(fit.intercept - model.intercept) < 5e-3
        assert all(fit.coef[i] == 0 for i in range(len(FEATURES)) if FEATURES[i] not in feats)
    got = {(r["model"], r["label"]): r["f1"] for r in scores_many(frame, "abcd", [f.probability(FEATURES) for f in fits]).collect()}
    for name, spec, rows in zip("abcd", specs, chosen):
        feats = [FEATURES[i] for i in (spec.columns or range(len(FEATURES)))]
        _, scores = M.evaluate(M.train(rows, 2, feats), frame)
        for r in scores.collect():
            assert got[name, r["label"]] == pytest.approx(r["f1"], abs=0.02)


def test_svm_keeps_no_second_copy_of_its_features(spark, frame, monkeypatch):
    """The solver keeps its own blocks; D numbers a row must not be kept beside them."""
    kept, plain = [], type(frame).persist
    monkeypatch.setattr(type(frame), "persist", lambda self, *a: kept.append(self.columns) or plain(self, *a))
    M.train(frame, 4, FEATURES)
    assert kept == [["label", "features"]]


def test_svm_is_that_of_spark_ml_in_one_pass_a_step(spark, monkeypatch):
    """the coefficients of ``LinearSVC`` on the random features, which no pass reads; a step is one pass."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector
    from bidscope.operators import svm
    from bidscope.operators.svm import fourier
    df, passes, plain = vectors(spark, 2000), [], svm.Rows.add_up
    monkeypatch.setattr(svm.Rows, "add_up", lambda self, *a: passes.append(1) or plain(self, *a))
    model = M.RbfSvm().fit(df)
    assert len(passes) <= 120                               # one for each of at most 100 steps, few more
    rows = [(r["label"], r["features"].toArray()) for r in df.collect()]
    z = fourier(np.array([x for _, x in rows]).T, model.w, model.b)
    assert np.allclose(z, np.sqrt(0.02) * np.cos(model.w @ np.array([x for _, x in rows]).T + model.b[:, None]), atol=1e-13)
    wide = spark.createDataFrame([(y, a.tolist()) for (y, _), a in zip(rows, z.T)], "label double, f array<double>")
    theirs = LinearSVC(featuresCol="z", regParam=1e-4, maxIter=100).fit(wide.select("label", array_to_vector("f").alias("z")).cache())
    assert np.allclose(model.svc.coefficients.toArray(), theirs.coefficients.toArray(), rtol=1e-6, atol=1e-6)
    assert np.isclose(model.svc.intercept, theirs.intercept, atol=1e-6)
    own = [r["m"] for r in model.transform(df).select((F.col("prediction") > 0).alias("m")).collect()]
    margin = z.T @ theirs.coefficients.toArray() + theirs.intercept
    p = 1 / (1 + np.exp(-(margin * model.platt.coefficients[0] + model.platt.intercept)))
    assert np.mean(np.array(own) == (p > 0.5)) > 0.999


def test_market_models_are_fit_at_the_same_time_and_equal_single_fits(frame, monkeypatch):
    import threading
    both, plain = threading.Barrier(2, timeout=60), M.train
    monkeypatch.setattr(M, "train", lambda *a: both.wait() is not None and plain(*a))      # one after the other never meets
    trained = M.train_markets(frame, ["X", "Y"], 2, FEATURES)
    for market, clf in trained:
        own = plain(frame.where(F.col("MarketplaceId") == market), clf, FEATURES, 0, M.MAX_DEPTH)["model"]
        assert np.allclose(own.coefficients.toArray(), trained[market, clf]["model"].coefficients.toArray())


def test_market_models_go_once_they_are_used(frame, monkeypatch):
    """a market's forest is scored as soon as it is fit and not held; the scores are those of all models together."""
    import gc
    import weakref
    monkeypatch.setattr(M, "AT_ONCE", 1)
    made, held, plain = [], [], M.train

    def train(*a):
        gc.collect()
        held.append(sum(m() is not None for m in made))
        out = plain(*a)
        made.append(weakref.ref(out["model"]))
        return out

    monkeypatch.setattr(M, "train", train)
    rows = frame.coalesce(1)
    found = M.train_markets(rows, ["X", "Y"], 1, FEATURES, max_depth=4, use=lambda market, clf, trained: M.evaluate_markets(
        {(market, clf): trained}, rows))
    assert held == [0, 0]
    own = sorted(r for part in found.values() for r in part.collect())
    assert own == sorted(M.evaluate_markets(M.train_markets(rows, ["X", "Y"], 1, FEATURES, max_depth=4), rows).collect())


def count_jobs(spark, call):
    """(result of ``call``, Spark jobs it took)."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    try:
        out = call()
        return out, len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def vectors(spark, n=400):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(n, 2)), rng.integers(0, 3, n)]
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=n) > 0.2).astype(float)
    rows = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, f array<double>")
    return rows.select("label", array_to_vector("f").alias("features")).coalesce(2).cache()


def test_adaboost_takes_one_pass_a_round(spark):
    """a round is one job, its stumps are those of weighted depth-1 trees of Spark ML."""
    from pyspark.ml.classification import DecisionTreeClassifier
    df = vectors(spark)
    rounds = 6
    model, jobs = count_jobs(spark, lambda: M.AdaBoost(rounds).fit(df))
    assert len(model.stumps) == rounds and jobs <= 2 * rounds
    tree = DecisionTreeClassifier(maxDepth=1, labelCol="label").fit(df)
    split = tree._call_java("rootNode").split()
    assert model.stumps[0][0] == split.featureIndex()
    hits = model.transform(df).where(F.col("prediction") == F.col("label")).count()
    assert hits >= tree.transform(df).where(F.col("prediction") == F.col("label")).count()


def test_boosted_trees_are_those_of_spark_ml_in_one_pass_a_level(spark):
    """the same probabilities as ``GBTClassifier``, with sums kept now and then; one job a tree level."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array
    df, rounds = vectors(spark), 10
    model, jobs = count_jobs(spark, lambda: M.BoostedTrees(rounds, 3, 0.1).fit(df))
    assert jobs <= 5 * rounds
    spark_ml = GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.1, seed=0, labelCol="label").fit(df)
    own = [r["prob"] for r in model.transform(df).collect()]
    want = [r["p"] for r in spark_ml.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert np.allclose(own, want, atol=1e-9)


def test_ablation_fits_all_steps_in_shared_passes(spark, frame):
    """the steps' class scores are those of one fit each; jobs do not grow with the steps."""
    added = ["gap", "fba", "n2"]
    steps, jobs = count_jobs(spark, lambda: M.ablation(frame, frame, ["n1"], added, 2))
    _, fewer = count_jobs(spark, lambda: M.ablation(frame, frame, ["n1"], added[:1], 2))
    assert jobs <= fewer + 8
    got = {(r["step"], r["label"]): r["f1"] for r in steps.collect()}
    assert len(got) == 8
    for i in (0, 3):
        _, scores = M.evaluate(M.train(frame, 2, ["n1", *added[:i]]), frame)
        for r in scores.collect():
            assert abs(got[i, r["label"]] - r["f1"]) < 0.02


@pytest.mark.parametrize("clf", [2, 5, 6])
def test_missing_features_are_refused(spark, frame, clf):
    """a missing feature raises, as it did in Spark ML's learners."""
    holes = frame.withColumn("n1", F.when(F.col("gap") > 1, F.col("n1")))
    with pytest.raises(Exception):
        if clf == 2:
            M.ablation(holes, frame, ["gap"], ["n1"], 2)
        else:
            M.train(holes, clf, FEATURES)
