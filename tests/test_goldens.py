"""FIXTURES.md §6 goldens and the §5 worked example."""

import math

import pytest
from pyspark.sql import functions as F

from bidscope.functions import grid as G
from bidscope.functions import scalars as P
from bidscope.operators import features as W
from bidscope.operators import reprice as RP


def _grid(spark, lo, mid, hi):
    df = spark.createDataFrame([(float(lo), float(mid), float(hi))], "lo double, mid double, hi double")
    return G.with_price_grid(df).first()["grid"]


@pytest.mark.parametrize("lo,mid,hi,n,total,first,last", [
    (10, 10, 11, 80, 839.35, 10.00, 11.00),
    (9, 10, 10, 50, 474.67, 9.00, 10.00),
    (12.66, 12.66, 13.926, 80, 1062.65, None, None),
])
def test_price_grid_goldens(spark, lo, mid, hi, n, total, first, last):
    g = _grid(spark, lo, mid, hi)
    assert len(g) == n
    assert round(sum(g), 2) == pytest.approx(total)
    assert g == sorted(set(g))
    if first is not None:
        assert g[0] == first and g[-1] == last


def test_price_grid_single_point_and_mirror(spark):
    assert _grid(spark, 10, 10, 10) == [10.0]
    g = _grid(spark, 9.5, 10, 11)
    assert len(g) == 75 and g[0] == pytest.approx(9.5) and g[-1] == 11.0


def test_text_code_and_time(spark):
    row = spark.range(1).select(P.text_code(F.lit("A1X")).alias("c"),
                                P.text_code(F.lit("")).alias("e"),
                                P.seconds_since_2016(F.lit("2017-01-27T15:34:28.123Z")).alias("t")).first()
    assert row["c"] == pytest.approx(13.392372193838877, abs=1e-12)
    assert row["e"] == -1.0
    assert row["t"] == pytest.approx(33924868.123)


def _curve(spark, degree):
    xs = [10.0, 10.1, 10.2, 10.3, 10.4, 10.5, 10.6]
    ys = [100.0, 90.0, 70.0, 40.0, 30.0, 10.0, 0.0]
    df = spark.createDataFrame([(1, x, y) for x, y in zip(xs, ys)], "k int, x double, y double")
    fit = RP.poly_smooth(df, ["k"], "x", "y", degree) if degree > 1 else RP.linear_smooth(df, ["k"], "x", "y")
    return [r["Smoothed"] for r in fit.orderBy("x").collect()]


def test_smoothing_goldens(spark):
    assert _curve(spark, 5) == pytest.approx(
        [99.7836, 91.2987, 66.7533, 44.3290, 26.7533, 11.2987, -0.2164], abs=1e-3)
    assert _curve(spark, 1) == pytest.approx(
        [102.142857, 84.285714, 66.428571, 48.571429, 30.714286, 12.857143, -5], abs=1e-5)


def test_worked_example(spark):
    rows = [("A3MWKKOMH9JCOC", 58.5, 0.0, 0, -1), ("AAGBRFV9S6RF9", 58.5, 0.0, 0, -1),
            ("AAGBRFV9S6RF9", 58.5, 0.0, 48, -1), ("A3RTF4R4P8C9DK", 58.5, 0.0, 0, -1),
            ("ATVPDKIKX0DER", 58.5, 0.0, 0, 1), ("A20OGRGQG17CVN", 69.0, 9.99, 120, -1)]
    df = spark.createDataFrame(
        [(i, "ATVPDKIKX0DER", "B002PEXC40", "x", s, l, sh, h, w) for i, (s, l, sh, h, w) in enumerate(rows)],
        "i int, MarketplaceId string, ProductId string, CompetitionName string, SellerId string, "
        "ListingPrice double, ShippingPrice double, ShippingTime_maxHours int, IsBuyBoxWinner int")
    df = P.landed_price(df)
    dim = spark.createDataFrame([("ATVPDKIKX0DER", "ATVPDKIKX0DER")], "MarketplaceId string, PlatformSellerId string")
    minima = spark.createDataFrame([("B002PEXC40", 55.69)], "ProductId string, min_landed double")
    f = W.platform_seller(df, dim)
    f = W.auction_features(f)                       # W1-W4 on raw hours
    f = W.diff_to_min_product(f, minima)
    f = W.minmax(f, "CompetitionName", "IdealPointCompetition", suffix="_n")
    floored = W.ideal_point(df.withColumn("ShippingTime_maxHours", P.ship_hours_floor("ShippingTime_maxHours")))
    got = {r["i"]: r for r in f.collect()}
    fl = {r["i"]: r["IdealPointCompetition"] for r in floored.collect()}
    w4 = [0, 0, -2808, 0, 0, -9478.8]
    w5 = [2.81, 2.81, 2.81, 2.81, 2.81, 23.3]
    w1 = [0, 0, 0, 0, 0, 20.49]
    w2 = [1, 1, 1, 1, 0, 1]
    w3 = [0, 0, 0, 0, 0, 20.49]
    w4p9 = [0, 0, -2749.5, 0, 0, -9420.3]
    w6 = [1, 1, 0.703760, 1, 1, 0]
    for i in range(6):
        r = got[i]
        assert r["IdealPointCompetition"] == pytest.approx(w4[i], abs=1e-6)
        assert r["DifftoMinLandedPriceProduct"] == pytest.approx(w5[i], abs=1e-6)
        assert r["DifftoMinLandedPriceCompetition"] == pytest.approx(w1[i], abs=1e-6)
        assert r["CompeteAmzCompetition"] == w2[i]
        assert r["DifftoAmzLandedPriceCompetition"] == pytest.approx(w3[i], abs=1e-6)
        assert fl[i] == pytest.approx(w4p9[i], abs=1e-6)
        assert r["IdealPointCompetition_n"] == pytest.approx(w6[i], abs=1e-6)
