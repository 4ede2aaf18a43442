"""Repricing jobs (R7, R8-R10): every listed auction in one set-based job.

``scorers`` maps a classifier name to a probability Column over the
candidate frame: a fixed expression, or a trained model's P(win) added by
``predict_candidates``.  The candidate frame is built once (R2) and
exploded by classifier; R3-R5 run once, keyed by (auction, classifier),
and the results are pivoted to one column per classifier.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.operators.events import attach_next_event, offers_of_events
from bidscope.operators.models import predict
from bidscope.operators.ranking import describe
from bidscope.operators.reprice import (CONTEXT, POLY_DEGREE, backtest, make_candidates, recommend,
                                        score_candidates, smooth_curve)
from bidscope.plans.features import candidate_features
from bidscope.schema import AUCTION
from bidscope.session import cut_lineage


def predict_candidates(frame: DataFrame, trained: Mapping[str, dict], platform_dim: DataFrame,
                       minima: DataFrame | None = None) -> DataFrame:
    """M4 on R2 rows: ``prob_<name>`` per model over the FP2 features of real
    offers and candidates together (``minima``: product minima stored with
    the models)."""
    out = candidate_features(frame.withColumn("_row", F.struct(*frame.columns)), platform_dim, minima)
    probs = []
    for name, model in trained.items():
        probs.append(f"prob_{name}")
        out = predict(model, out).withColumnRenamed("prob", probs[-1]).drop("predicted")
    return out.select("_row.*", *probs)


def reprice_frame(frame: DataFrame, events: DataFrame, scorers: Mapping[str, Column],
                  degree: int = POLY_DEGREE) -> DataFrame:
    """R3 -> R4 -> R5 of a candidate frame for every scorer at once, then pivot and J5."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("clf"), p.cast("double").alias("prob"))
                               for n, p in scorers.items()]))
    keys = (AUCTION, "clf")
    rows = frame.withColumn("_s", each).select("*", "_s.clf", "_s.prob").drop("_s")
    smooth = smooth_curve(score_candidates(rows, "prob", keys), keys, degree, CONTEXT)
    _, rec = recommend(smooth, keys)
    wide = rec.groupBy("File", *CONTEXT).pivot("clf", list(scorers)).agg(F.first("RecommendedPrice"))
    return attach_next_event(wide.withColumnRenamed("CustomerPrice", "CurrentPrice"), events)


def reprice_many(offers: DataFrame, events: DataFrame, scorers: Mapping[str, Column],
                 history: DataFrame | None = None, degree: int = POLY_DEGREE) -> DataFrame:
    """J1 -> R2 -> (R3 -> R4 -> R5 per classifier) -> pivot -> J5.

    Output: File, CurrentPrice, WinnerPrice, CustomerStatus, one column per
    classifier (recommended price), NextFile, NextPrice.
    """
    events = cut_lineage(events)        # read twice: to list the auctions and for J5
    frame = make_candidates(offers_of_events(offers, events), history if history is not None else offers)
    return reprice_frame(frame, events, scorers, degree)


def reprice_models(offers: DataFrame, events: DataFrame, trained: Mapping[str, dict], platform_dim: DataFrame,
                   minima: DataFrame | None = None, history: DataFrame | None = None,
                   degree: int = POLY_DEGREE) -> DataFrame:
    """R7 with trained models: J1 -> R2 -> FP2 + M4 per model -> R3 -> R4 -> R5."""
    events = cut_lineage(events)
    frame = make_candidates(offers_of_events(offers, events), history if history is not None else offers)
    scored = predict_candidates(frame, trained, platform_dim, minima)
    return reprice_frame(scored, events, {n: F.col(f"prob_{n}") for n in trained}, degree)


def backtest_summary(results: DataFrame, classifiers: list[str]) -> DataFrame:
    """R8 + A8: describe the recommendation gap per classifier."""
    gaps = cut_lineage(backtest(results, classifiers))      # read by every pass
    return describe(gaps, "gap", ["clf"])
