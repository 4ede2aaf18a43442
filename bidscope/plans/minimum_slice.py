"""Flagship: for every auction with exactly one winner, does the
best-scoring offer win?

F5 -> P8 -> P9 -> W1 + W4 -> W6(ideal point by auction) -> M5 with a
fixed probability -> W8 -> A5 / A6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.scalars import landed_price, ship_hours_floor
from bidscope.operators.clean import exactly_one_winner
from bidscope.operators.features import auction_features, minmax
from bidscope.operators.metrics import class_scores, confusion_matrix
from bidscope.operators.scoring import decide_winner
from bidscope.schema import AUCTION, IDEAL_POINT, MAX_HOURS, WINNER


def scored_offers(offers: DataFrame, prob: float = 0.5) -> DataFrame:
    df = exactly_one_winner(offers)
    df = landed_price(df).withColumn(MAX_HOURS, ship_hours_floor(MAX_HOURS))
    df = auction_features(df, with_platform=False)
    df = minmax(df, AUCTION, IDEAL_POINT)
    return decide_winner(df, prob)


def minimum_slice(offers: DataFrame, prob: float = 0.5) -> DataFrame:
    """Confusion matrix (actual, predicted, n) of the decided winners."""
    return confusion_matrix(scored_offers(offers, prob), WINNER, "NewDecision")


def minimum_slice_scores(offers: DataFrame, prob: float = 0.5) -> DataFrame:
    """Per-class precision / recall / F1 / support of the decided winners."""
    return class_scores(scored_offers(offers, prob), WINNER, "NewDecision")
