"""Feature pipelines (FP1-FP3): one lazy plan per frame.

Shuffle plan: the per-product statistics (W5 with its W6) are one product
aggregate (hot products are combined map-side), joined to the narrow offers;
the per-auction statistics (W1-W4, W6, W12) are windows over the auction key
and share one exchange after that; the platform dimension (one row per
market) is joined on its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.scalars import (drop_if_present, landed_price, ship_hours_floor,
                                        text_code)
from bidscope.operators.features import (PLATFORM, PRICE_STATS, auction_features, auction_split_flags,
                                         diff_from_stats, minmax, normalise_all,
                                         platform_seller, product_minima, product_price_stats)
from bidscope.schema import (AUCTION, DIFF_MIN_PRODUCT, IDEAL_POINT, LANDED, LISTING, MARKET,
                             MAX_HOURS, MIN_HOURS, PRODUCT, SHIPPING, WINNER)
from bidscope.session import cut_lineage

PRE_DROP = ["ListingCurrency", "ShippingCurrency", MARKET, "ShipsDomestically"]   # P12
POST_DROP = [LISTING, SHIPPING, MIN_HOURS]                                         # P12


RAW_LANDED = "_raw_landed"


def _auction_part(df: DataFrame, platform_dim: DataFrame) -> DataFrame:
    """P11 -> P12 -> P8, W1 -> W2, W3 -> P9 -> W4, W6 by auction; the landed price
    before W6 is kept as ``RAW_LANDED`` for the product difference."""
    out = platform_seller(df, platform_dim)
    out = drop_if_present(out, PRE_DROP)
    out = landed_price(out).withColumn(MAX_HOURS, ship_hours_floor(MAX_HOURS))
    out = auction_features(out).withColumn(RAW_LANDED, F.col(LANDED))
    return minmax(out, AUCTION, [LISTING, SHIPPING, LANDED, IDEAL_POINT])


def _with_product(df: DataFrame, minima: DataFrame | None) -> DataFrame:
    """Rows with their product's price statistics.  They are joined while rows are narrow;
    the exchange to the auctions, which all windows share, comes after."""
    landed = landed_price(df.select(PRODUCT, LISTING, SHIPPING)).select(PRODUCT, LANDED)
    return df.drop(DIFF_MIN_PRODUCT).join(product_price_stats(landed, minima), on=PRODUCT, how="left")


def add_features(df: DataFrame, platform_dim: DataFrame,
                 minima: DataFrame | None = None) -> DataFrame:
    """Shared part of FP1/FP2: P11 -> P12 -> P8, W1 -> W2, W3 -> P9 -> W4
    -> W5 (+J3 with ``minima``) -> W6 of listing, shipping, landed, ideal
    point by auction, product diff by product -> P12."""
    out = diff_from_stats(_auction_part(_with_product(df, minima), platform_dim), normalise=True, price=RAW_LANDED)
    return drop_if_present(out, POST_DROP + [PLATFORM, RAW_LANDED])


def candidate_features(frame: DataFrame, platform_dim: DataFrame,
                       minima: DataFrame | None = None) -> DataFrame:
    """FP2 columns on R2 rows (offers and candidates of an auction together).

    The landed price is the row's own (a candidate's is its grid price); the
    product difference is taken to the stored minimum, else to the history
    minimum of R2, and scaled by auction, as one job per auction sees it.
    """
    out = platform_seller(frame, platform_dim).withColumn(MAX_HOURS, ship_hours_floor(MAX_HOURS))
    out = auction_features(out)
    if minima is not None:
        known = minima.select(PRODUCT, F.col("min_landed").alias("_known"))
        out = out.join(known, on=PRODUCT, how="left").withColumn(
            DIFF_MIN_PRODUCT, F.col(LANDED) - F.coalesce("_known", "ProductMinPrice")).drop("_known")
    out = minmax(out, AUCTION, [LISTING, SHIPPING, LANDED, IDEAL_POINT, DIFF_MIN_PRODUCT])
    return out.drop(PLATFORM)


def code_text(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """P10 on every string column (except ``skip``)."""
    return df.select(*[text_code(f.name).alias(f.name)
                       if isinstance(f.dataType, T.StringType) and f.name not in skip
                       else F.col(f.name) for f in df.schema.fields])


def train_features(df: DataFrame, platform_dim: DataFrame,
                   minima: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """FP1: add_features -> P10 -> W12 (every column but label, product
    diff, auction, product min-max scaled by auction).  The ids are text-coded last, after
    they have served as keys.  Columns ``keep`` pass as they are."""
    keep = [*keep, *PRICE_STATS]
    f = _auction_part(_with_product(df, minima), platform_dim)
    f = code_text(drop_if_present(f, POST_DROP + [PLATFORM]), skip=[AUCTION, PRODUCT, *keep])
    f = normalise_all(f, AUCTION, exclude=(WINNER, RAW_LANDED, AUCTION, PRODUCT, *keep))
    return code_text(diff_from_stats(f, normalise=True, price=RAW_LANDED).drop(RAW_LANDED), skip=keep)


def serve_features(df: DataFrame, platform_dim: DataFrame, minima: DataFrame | None,
                   ranked: Sequence[str], n: int, keep: Sequence[str] = ()) -> DataFrame:
    """FP2: add_features -> label + top-n ranked features (+ ``keep``) -> P10;
    no W12 (quirk Q9)."""
    f = add_features(df, platform_dim, minima)
    cols = [WINNER, *list(ranked)[:n], *[k for k in keep if k not in ranked[:n]]]
    return code_text(f.select(*cols), skip=keep)


IS_TEST = "is_test"


def train_test_frame(df: DataFrame, platform_dim: DataFrame, ratio: float = 0.3, time_col: str = "Time",
                     keep: Sequence[str] = (), flags: DataFrame | None = None) -> DataFrame:
    """FP3 as one frame with the side of each row in ``is_test``.

    Auctions are whole on either side (W11), so everything by auction is built once
    for both.  Product statistics are one aggregate with a minimum and a maximum per side;
    test rows are compared with the minimum learned on train (J3), else with their own.
    ``flags``: the sides of the auctions (W11) where they are known.
    """
    if flags is None:
        flags = auction_split_flags(df, ratio, time_col)
    tagged = df.join(flags, on=AUCTION, how="inner").drop(time_col)
    landed, test = F.col(LISTING) + F.col(SHIPPING), F.col(IS_TEST)
    ends = tagged.groupBy(PRODUCT).agg(F.min(F.when(~test, landed)).alias("_l0"), F.max(F.when(~test, landed)).alias("_h0"),
                                       F.min(F.when(test, landed)).alias("_l1"), F.max(F.when(test, landed)).alias("_h1"))
    learned = F.coalesce(F.col("_l0"), F.col("_l1"))
    lo, hi = F.when(test, F.col("_l1")).otherwise(F.col("_l0")), F.when(test, F.col("_h1")).otherwise(F.col("_h0"))
    keep = [IS_TEST, *keep]
    f = _auction_part(tagged.drop(DIFF_MIN_PRODUCT), platform_dim)
    f = code_text(drop_if_present(f, POST_DROP + [PLATFORM]), skip=[AUCTION, PRODUCT, *keep])
    f = normalise_all(f, AUCTION, exclude=(WINNER, RAW_LANDED, AUCTION, PRODUCT, *keep))
    # joined last: the rows come to the windows as the flags' join deals them, by auction
    f = f.join(ends, on=PRODUCT, how="left").withColumns({"_m": learned, "_dlo": lo - learned, "_dhi": hi - learned}).drop(
        "_l0", "_h0", "_l1", "_h1")
    return code_text(diff_from_stats(f, normalise=True, price=RAW_LANDED).drop(RAW_LANDED), skip=keep)


def train_test_features(df: DataFrame, platform_dim: DataFrame, ratio: float = 0.3,
                        time_col: str = "Time", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """FP3: W11 split by auction order; product minima learned on train (A1)
    and applied to test (J3).  Returns (train, test, minima); the frame of both sides is
    computed once and cut off from its lineage."""
    flags = auction_split_flags(df, ratio, time_col)        # auctions are ranked once, for frame and minima
    both = cut_lineage(train_test_frame(df, platform_dim, ratio, time_col, keep, flags))
    train = df.join(flags.where(~F.col(IS_TEST)), on=AUCTION, how="inner")
    return (both.where(~F.col(IS_TEST)).drop(IS_TEST), both.where(IS_TEST).drop(IS_TEST),
            product_minima(landed_price(train)))
