"""Candidates packed as arrays: the rows of the row form, no candidate row shuffled or sorted."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from bidscope.functions import grid as G
from bidscope.operators import reprice as RP

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def few(spark):
    """Auctions of 1 to 5 offers; no, one and many winners, equal prices, zero hours, two customers in one."""
    out, n = [], 0
    for a in range(24):
        for i in range(1 + a % 5):
            n += 1
            out.append((a, a % 3, n, 1 if (a + i) % 3 == 0 and a % 4 else -1, int(i == 0 or (a == 7 and i == 1)), 10.0 + (a * 7 + i * 3) % 11 / 4,
                        0.5 * (i % 2) if a % 6 else 0.0, 24 * ((a + i) % 3), (a + i) % 2, i % 2))
    return spark.createDataFrame(out, "CompetitionName long, ProductId long, SellerId long, IsBuyBoxWinner int, IsCustomer int, ListingPrice double, "
                                      "ShippingPrice double, ShippingTime_maxHours int, IsFulfilledByAmazon int, IsFeaturedMerchant int")


@pytest.mark.parametrize("prob", [0.5, "feat", "price"])
def test_packed_scores_are_those_of_rows(few, prob):
    p = {"feat": F.lit(0.25) + F.lit(0.5) * F.col("IsFeaturedMerchant"), "price": F.col("LandedPrice") / 20}.get(prob, prob)
    cols = ["CompetitionName", "SellerId", "is_candidate", "LandedPrice", "DifftoMinLandedPriceProduct", "Score"]
    packed = RP.score_candidates(RP.pack_candidates(few), p)
    assert (RP.SCORED in packed.columns) == (prob != "price")        # a probability of the price needs rows
    plain = RP.score_candidates(RP.make_candidates(few), p)
    flat = RP.unpack(packed) if RP.SCORED in packed.columns else packed
    assert rows(flat.select(*cols)) == rows(plain.select(*cols))
    for degree, orthogonal in ((1, False), (5, False), (5, True)):
        a, b = (RP.smooth_curve(s, ("CompetitionName",), degree, RP.CONTEXT, orthogonal) for s in (packed, plain))
        assert [c for c in a.columns] == [c for c in b.columns]
        for x, y in zip(rows(a), rows(b), strict=True):
            assert x == pytest.approx(y, abs=1e-5)
    if prob != "price":
        curve = RP.pack_curve(packed, ("CompetitionName",), 1, RP.CONTEXT)
        for a, b in zip(RP.recommend(curve), RP.recommend(RP.smooth_curve(plain, ("CompetitionName",), 1, RP.CONTEXT)), strict=True):
            assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(b.columns)))


@pytest.mark.parametrize("name", ["r3_score_candidates", "r4_smooth_curve_linear", "r4_smooth_curve_orthogonal", "r4_smooth_curve_poly5",
                                  "k1_top_candidates", "r5_recommend", "r6_auction_scores"])
def test_no_candidate_row_is_exchanged(spark, name):
    """Above the explode there is no exchange, nor windows but those of the orthogonal curve."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    above = re.split(r"Generate posexplode", plan)[0] if "Generate posexplode" in plan else ""
    assert "Exchange" not in above and "size(" not in above
    assert name == "r4_smooth_curve_orthogonal" or "Window" not in above


@pytest.mark.parametrize("name", ["g7_limit_prices", "j7_candidate_expansion"])
def test_grids_are_computed_once(spark, name):
    """No filter on the array's size holds a copy of all that computes it."""
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LOG10") <= 6 and len(plan) < 40_000


def test_limited_prices_equal_the_expression(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0], c, s) for c in (0.5, 1.0, 2.5, 3.0, 4.0) for s in (-1, 0, 1)] + [([5.0], 5.0, 1), ([5.0], 4.0, -1)],
                               "p array<double>, c double, s int")
    both = G.with_limited_prices(df, "p", "c", "s").withColumn("e", G.limit_prices(F.col("p"), F.col("c"), F.col("s")))
    assert all(r["limited"] == r["e"] for r in both.collect())
