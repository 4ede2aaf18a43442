"""Winner scoring (M5, M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.operators.features import argmax_decision
from bidscope.schema import AUCTION, FBA, FEATURED, IDEAL_POINT


def new_score_expr(prob: Column, fba: str = FBA, ideal: str = IDEAL_POINT,
                   featured: str = FEATURED) -> Column:
    """M5: prob * (FBA + IdealPoint + Featured), summed term by term in
    this order so equal scores stay bit-equal."""
    return F.col(fba) * prob + prob * F.col(ideal) + prob * F.col(featured)


def new_score(df: DataFrame, prob: str | float = "prob", out: str = "NewScore") -> DataFrame:
    """M5 on a frame with a probability column (or a fixed probability)."""
    p = F.col(prob) if isinstance(prob, str) else F.lit(float(prob))
    return df.withColumn(out, new_score_expr(p))


def decide_winner(df: DataFrame, prob: str | float = "prob", group: str = AUCTION) -> DataFrame:
    """M6: M5 then W8 -> NewScore, NewDecision (+1 on the auction max)."""
    return argmax_decision(new_score(df, prob), "NewScore", group, "NewDecision")
