"""Logistic models of many subsets or feature lists in shared passes.

Folds, training sizes and feature counts differ in the rows or columns they use, not
in the data they read.  Newton's method needs of each pass, for each model, one gradient
and one matrix of (features + 1) squared numbers; so one scan per iteration serves all
models: tasks add up both for every model (NumPy, one matrix product a batch) and Spark
sums them by model and place.  The driver solves the small systems.

The optimum is that of ``LogisticRegression(regParam)``: mean loss plus half of
``reg`` times the squared coefficients of the standardised features, the intercept free.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.scalars import to_01
from bidscope.operators.scoring import new_score_expr
from bidscope.schema import AUCTION, WINNER

REG = 1e-4          # that of classifier 2


@dataclass
class Spec:
    """One model: which rows teach it, and which features it has (places; None: all)."""
    rows: Column
    columns: Sequence[int] | None = None


@dataclass
class Fit:
    coef: np.ndarray
    intercept: float
    iterations: int

    def probability(self, features: Sequence[str]) -> Column:
        z = F.lit(float(self.intercept))
        for name, c in zip(features, self.coef):
            if c:
                z = z + F.lit(float(c)) * F.col(name)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _pass(data: DataFrame, n_features: int, n_models: int, betas: np.ndarray | None) -> np.ndarray:
    """(models, numbers): of each model the rows, sums and squares of its features when ``betas`` is
    None, else its loss, gradient and matrix at ``betas`` (intercept last)."""
    def run(batches):
        import pyarrow as pa
        total = None
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[:n_features]], 1) \
                if n_features else np.zeros((batch.num_rows, 0))
            y = batch.column(n_features).to_numpy(zero_copy_only=False).astype(float)
            member = np.stack([batch.column(n_features + 1 + m).to_numpy(zero_copy_only=False) for m in range(n_models)]).astype(bool)
            x = np.concatenate([x, np.ones((len(x), 1))], 1)
            rows = []
            for m in range(n_models):
                xm, ym = x[member[m]], y[member[m]]
                if betas is None:
                    rows.append(np.concatenate([[len(xm)], xm.sum(0), (xm * xm).sum(0), [ym.sum()]]))
                    continue
                z = xm @ betas[m]
                p = 1 / (1 + np.exp(-z))
                loss = (np.logaddexp(0, z) - ym * z).sum()
                rows.append(np.concatenate([[loss], xm.T @ (p - ym), ((xm * (p * (1 - p))[:, None]).T @ xm).ravel()]))
            total = np.array(rows) if total is None else total + np.array(rows)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(n_models), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                                             names=["model", "sums"])

    parts = data.mapInArrow(run, "model int, sums array<double>").select("model", F.posexplode("sums").alias("place", "value"))
    found = parts.groupBy("model", "place").agg(F.sum("value").alias("value")).collect()     # a few numbers a model
    size = max((r["place"] for r in found), default=-1) + 1
    out = np.zeros((n_models, size))
    for r in found:
        out[r["model"], r["place"]] = r["value"]
    return out


def fit_many(frame: DataFrame, features: Sequence[str], specs: Sequence[Spec], reg: float = REG,
             tol: float = 1e-9, most: int = 50) -> list[Fit]:
    """The models of ``specs``; the frame is read once and then once per iteration."""
    d, k = len(features), len(specs)
    data = frame.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], to_01(WINNER).cast("double").alias("y"),
                        *[F.coalesce(s.rows, F.lit(False)).alias(f"m{i}") for i, s in enumerate(specs)])
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = _pass(data, d, k, None)
        if not first.size:
            return [Fit(np.zeros(d), 0.0, 0) for _ in specs]
        n = first[:, 0]
        mean, square = first[:, 1:d + 1] / np.maximum(n, 1)[:, None], first[:, d + 2:2 * d + 2]
        var = (square - n[:, None] * mean ** 2) / np.maximum(n - 1, 1)[:, None]
        std = np.sqrt(np.where(var > 1e-14 * np.maximum(mean ** 2, 1e-300), var, 0))
        use = std > 0
        for m, s in enumerate(specs):
            if s.columns is not None:
                use[m, np.setdiff1d(np.arange(d), list(s.columns))] = False
        scale = np.where(use, 1 / np.where(std > 0, std, 1), 0)
        # in standardised terms: theta (d, centred) and the intercept
        theta, last, lost = np.zeros((k, d + 1)), np.zeros((k, d + 1)), np.full(k, np.inf)
        share = first[:, 2 * d + 3] / np.maximum(n, 1)
        theta[:, d] = np.log(np.clip(share, 1e-12, 1 - 1e-12) / (1 - np.clip(share, 1e-12, 1 - 1e-12)))
        open_, rounds = (n > 0) & (share > 0) & (share < 1), 0
        while open_.any() and rounds < most:
            beta = np.concatenate([theta[:, :d] * scale, (theta[:, d] - (theta[:, :d] * scale * mean).sum(1))[:, None]], 1)
            got = _pass(data, d, k, beta)
            rounds += 1
            for m in np.flatnonzero(open_):
                # gradient and matrix of (x - mean) / std from those of x
                turn = np.zeros((d + 1, d + 1))
                turn[:d, :d] = np.diag(scale[m])
                turn[d, :d] = -scale[m] * mean[m]
                turn[d, d] = 1
                loss = got[m, 0] / n[m] + reg / 2 * (theta[m, :d] ** 2).sum()
                if loss > lost[m] + 1e-12:               # too long a step: half of it
                    theta[m] = (theta[m] + last[m]) / 2
                    continue
                grad = turn.T @ got[m, 1:d + 2] / n[m] + np.append(reg * theta[m, :d], 0)
                matrix = turn.T @ got[m, d + 2:].reshape(d + 1, d + 1) @ turn / n[m] + np.diag(np.append(np.full(d, reg), 0))
                at = np.append(np.flatnonzero(use[m]), d)
                move = np.zeros(d + 1)
                move[at] = np.linalg.solve(matrix[np.ix_(at, at)] + 1e-14 * np.eye(len(at)), grad[at])
                last[m], lost[m] = theta[m].copy(), loss
                theta[m] = theta[m] - move
                open_[m] = np.abs(move).max() > tol
        coef = theta[:, :d] * scale
        return [Fit(coef[m], float(theta[m, d] - (coef[m] * mean[m]).sum()), rounds) for m in range(k)]
    finally:
        data.unpersist()


def scores_many(frame: DataFrame, names: Sequence, probs: Sequence[Column], rows: Sequence[Column] | None = None) -> DataFrame:
    """M7 of many models in one pass: (model, label, precision, recall, f1, support).

    All models' scores share the windows by auction; model i counts the rows where
    ``rows[i]`` holds (whole auctions).
    """
    w = Window.partitionBy(AUCTION)
    scored = frame.select(AUCTION, WINNER, *[new_score_expr(p).alias(f"_s{i}") for i, p in enumerate(probs)],
                          *[r.alias(f"_r{i}") for i, r in enumerate(rows or [])])
    said = scored.select(F.col(WINNER).alias("a"), *[F.when(F.col(f"_s{i}") == F.max(f"_s{i}").over(w), 1).otherwise(-1).alias(f"_d{i}")
                                                     for i in range(len(probs))], *[f"_r{i}" for i in range(len(rows or []))])
    each = [F.struct(F.lit(i).alias("i"), F.col("a"), F.col(f"_d{i}").alias("p"),
                     (F.col(f"_r{i}") if rows else F.lit(True)).alias("in")) for i in range(len(probs))]
    flat = said.select(F.explode(F.array(*each)).alias("e")).select("e.*").where("in")
    label = F.explode(F.array(F.lit(-1), F.lit(1)))
    per = (flat.select("i", "a", "p", label.alias("label"))
           .groupBy("i", "label").agg(F.sum(((F.col("a") == F.col("label")) & (F.col("p") == F.col("label"))).cast("double")).alias("tp"),
                                      F.sum((F.col("p") == F.col("label")).cast("double")).alias("pp"),
                                      F.sum((F.col("a") == F.col("label")).cast("long")).alias("support")))
    precision = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    out = per.select("i", "label", precision.alias("precision"), recall.alias("recall"), "support")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    named = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(i), F.lit(name))])
    return out.select(named[F.col("i")].alias("model"), "label", "precision", "recall", f1.alias("f1"), "support")
