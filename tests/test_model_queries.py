"""Queries that fit models, on offers made here."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from bidscope.operators import features as W
from bidscope.operators import models as M
from bidscope.operators import ranking
from bidscope.plans import catalog_reprice
from bidscope.plans import features as FP

VIEW = ("MarketplaceId string, ProductId long, SellerId long, CompetitionName long, l_orderkey long, l_linenumber int, "
        "l_shipdate date, IsBuyBoxWinner int, IsFulfilledByAmazon int, IsFeaturedMerchant int, ListingPrice double, "
        "ShippingPrice double, ShippingTime_maxHours int, s_acctbal double, IsCustomer int, auction_time date")


def view(spark, n_auctions=60):
    """Offers of the auction view: two markets, three products, four sellers an auction."""
    rng, rows = np.random.default_rng(8), []
    for a in range(n_auctions):
        price = np.round(rng.uniform(10, 20, 4), 2)
        for i in range(4):
            day = dt.date(1995, 1, 1) + dt.timedelta(days=a + i % 2)
            rows.append((f"m{a % 2}", a % 6, i, a, a, i, day, 1 if price[i] == price.min() else -1, i % 2, int(rng.integers(2)),
                         float(price[i]), 0.5 * i, 24 * i, 100.0 * i, int(i == a // 6 % 4), dt.date(1995, 1, 1) + dt.timedelta(days=a)))
    return spark.createDataFrame(rows, VIEW)


def test_reprice_with_two_models_runs_to_its_end(spark, monkeypatch):
    real = M.estimator
    monkeypatch.setattr(M, "estimator", lambda clf, seed=0, max_depth=3: real(clf, seed, 3))       # shallow: fewer passes
    out = catalog_reprice.q_r7_models(view(spark))
    assert {"RandomForest", "LogisticRegression", "File", "NextPrice"} <= set(out.columns)
    rows = out.collect()
    assert rows and all(r["RandomForest"] is not None and r["LogisticRegression"] is not None for r in rows)


def test_auctions_are_ranked_once_for_frame_and_minima(spark, monkeypatch):
    ranked, real = [], ranking.global_rank_count
    monkeypatch.setattr(ranking, "global_rank_count", lambda *a, **k: ranked.append(1) or real(*a, **k))
    df = catalog_reprice.fp_input(view(spark), with_time=True)
    train, test, minima = FP.train_test_features(df, W.derived_platform_dimension(df))
    assert len(ranked) == 1
    assert (train.count(), test.count()) == (42 * 4, 18 * 4)
    later = df.where(F.col("CompetitionName").cast("int") >= 18)
    want = {r[0]: r[1] for r in later.groupBy("ProductId").agg(F.min(F.col("ListingPrice") + F.col("ShippingPrice"))).collect()}
    assert {r["ProductId"]: r["min_landed"] for r in minima.collect()} == want
