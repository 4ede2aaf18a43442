"""Group-relative price features (W1-W8, W12) and their lookups.

Each operator appends columns; all group statistics go through
``with_group_stats`` (aggregate + join back, see ``groups.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.operators.groups import with_group_stats, minmax_expr, group_stats
from bidscope.schema import (AUCTION, COMPETES_PLATFORM, DIFF_MIN_AUCTION,
                             DIFF_MIN_PRODUCT, DIFF_PLATFORM, IDEAL_POINT, LANDED,
                             MARKET, MAX_HOURS, NO_PLATFORM, PRODUCT, SELLER, WINNER)

PLATFORM = "PlatformSellerId"
NO_PLATFORM_DIFF = -9999.0  # P22: sentinel when the auction has no platform offer


def local_table(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A small dimension as a local table to broadcast; past ``max_rows`` rows the
    frame is returned as it is and joined by shuffle."""
    rows = df.limit(max_rows + 1).collect()
    return df if len(rows) > max_rows else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def platform_seller(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach the market's platform seller id (``PlatformSellerId``).

    ``dimension`` has one row per market (MarketplaceId, PlatformSellerId).
    It is fetched under a checked bound and then joined as a local table,
    so offers are never shuffled on the market.
    Markets without an entry get 'nothing' (string ids) or null.
    """
    dim = local_table(dimension.select(MARKET, PLATFORM))
    out = df.drop(PLATFORM).join(dim, on=MARKET, how="left")
    if isinstance(out.schema[PLATFORM].dataType, T.StringType):
        out = out.withColumn(PLATFORM, F.coalesce(F.col(PLATFORM), F.lit(NO_PLATFORM)))
    return out


def derived_platform_dimension(df: DataFrame) -> DataFrame:
    """Platform seller per market for data without the fixed table:
    the smallest seller id of the market (used by the auction view)."""
    return df.groupBy(MARKET).agg(F.min(SELLER).alias(PLATFORM))


def known_markets(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """keep markets that have a platform seller."""
    return df.join(local_table(dimension.select(MARKET).distinct()), on=MARKET, how="left_semi")


def diff_to_min_auction(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """LandedPrice - min LandedPrice of the auction."""
    out = with_group_stats(df, group, {"_mn": F.min(LANDED)})
    return out.withColumn(DIFF_MIN_AUCTION, F.col(LANDED) - F.col("_mn")).drop("_mn")


def _is_platform() -> Column:
    return F.coalesce(F.col(SELLER) == F.col(PLATFORM), F.lit(False))


def competes_with_platform(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """1 if the auction holds a platform offer, else -1; 0 on the
    platform's own rows.  Needs ``PlatformSellerId`` (P11)."""
    out = with_group_stats(df, group, {"_hasp": F.max(_is_platform().cast("int"))})
    return out.withColumn(COMPETES_PLATFORM, F.when(_is_platform(), 0)
                          .when(F.col("_hasp") == 1, 1).otherwise(-1)).drop("_hasp")


def diff_to_platform(df: DataFrame, group: str = AUCTION,
                     fallback: str = "sentinel") -> DataFrame:
    """LandedPrice - min platform LandedPrice in the auction.

    No platform offer: -9999 (``fallback="sentinel"``) or the difference
    to the auction minimum (``fallback="min"``).
    """
    out = with_group_stats(df, group, {
        "_pmin": F.min(F.when(_is_platform(), F.col(LANDED))),
        "_mn": F.min(LANDED)})
    alt = F.lit(NO_PLATFORM_DIFF) if fallback == "sentinel" else F.col(LANDED) - F.col("_mn")
    return out.withColumn(DIFF_PLATFORM, F.when(F.col("_pmin").isNull(), alt)
                          .otherwise(F.col(LANDED) - F.col("_pmin"))).drop("_pmin", "_mn")


def ideal_point(df: DataFrame, group: str = AUCTION, hours: str = MAX_HOURS) -> DataFrame:
    """min(Landed)*min(hours) - Landed*hours over the auction (<= 0)."""
    out = with_group_stats(df, group, {"_ml": F.min(LANDED), "_mh": F.min(hours)})
    return out.withColumn(IDEAL_POINT, F.col("_ml") * F.col("_mh") - F.col(LANDED) * F.col(hours)) \
              .drop("_ml", "_mh")


def auction_features(df: DataFrame, group: str = AUCTION, hours: str = MAX_HOURS,
                     with_platform: bool = True, fallback: str = "sentinel") -> DataFrame:
    """W1 + W2 + W3 + W4 from ONE auction aggregate and one join back."""
    aggs = {"_mn": F.min(LANDED), "_mh": F.min(hours)}
    if with_platform:
        aggs["_pmin"] = F.min(F.when(_is_platform(), F.col(LANDED)))
        aggs["_hasp"] = F.max(_is_platform().cast("int"))
    out = with_group_stats(df, group, aggs)
    out = out.withColumn(DIFF_MIN_AUCTION, F.col(LANDED) - F.col("_mn"))
    if with_platform:
        alt = F.lit(NO_PLATFORM_DIFF) if fallback == "sentinel" else F.col(LANDED) - F.col("_mn")
        out = (out.withColumn(DIFF_PLATFORM, F.when(F.col("_pmin").isNull(), alt)
                              .otherwise(F.col(LANDED) - F.col("_pmin")))
                  .withColumn(COMPETES_PLATFORM, F.when(_is_platform(), 0)
                              .when(F.col("_hasp") == 1, 1).otherwise(-1)))
    out = out.withColumn(IDEAL_POINT, F.col("_mn") * F.col("_mh") - F.col(LANDED) * F.col(hours))
    return out.drop(*aggs.keys())


def product_minima(df: DataFrame) -> DataFrame:
    """A1: (ProductId, min_landed)."""
    return df.groupBy(PRODUCT).agg(F.min(LANDED).alias("min_landed"))


PRICE_STATS = ("_m", "_dlo", "_dhi")


def product_price_stats(source: DataFrame, minima: DataFrame | None = None) -> DataFrame:
    """(ProductId, _m, _dlo, _dhi): the minimum that W5 subtracts, and the least and greatest
    difference to it, from one product aggregate of (ProductId, LandedPrice).

    The minimum comes from ``minima`` (ProductId, min_landed) when given, else from
    this data; products missing from ``minima`` fall back to their own minimum here.
    x - m is monotone in x, so the ends of the difference are those of LandedPrice minus m.
    """
    stats = group_stats(source, PRODUCT, {"_own": F.min(LANDED), "_max": F.max(LANDED)})
    if minima is not None:
        stats = stats.join(minima.select(PRODUCT, F.col("min_landed").alias("_given")), on=PRODUCT, how="left")
        m = F.coalesce(F.col("_given"), F.col("_own"))
    else:
        m = F.col("_own")
    return stats.select(PRODUCT, m.alias("_m"), (F.col("_own") - m).alias("_dlo"), (F.col("_max") - m).alias("_dhi"))


def diff_from_stats(df: DataFrame, normalise: bool = False, price: str = LANDED) -> DataFrame:
    """W5 (and W6 by product with ``normalise``, constant -> 1) of rows that carry ``PRICE_STATS``."""
    diff = F.col(price) - F.col("_m")
    if normalise:
        diff = minmax_expr(diff, F.col("_dlo"), F.col("_dhi"))
    return df.withColumn(DIFF_MIN_PRODUCT, diff).drop(*PRICE_STATS)


def diff_to_min_product(df: DataFrame, minima: DataFrame | None = None, normalise: bool = False) -> DataFrame:
    """W5 + J3: LandedPrice - product minimum (see ``product_price_stats``)."""
    rows = df.drop(DIFF_MIN_PRODUCT).join(product_price_stats(df, minima), on=PRODUCT, how="left")
    return diff_from_stats(rows, normalise)


def minmax(df: DataFrame, group: str | Sequence[str], cols: str | Sequence[str],
           constant: float = 1.0, suffix: str = "") -> DataFrame:
    """W6 (constant -> 1) / W7 (``constant=0``): per-group min-max scaling
    of one or many columns with a single aggregate."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    aggs = {}
    for i, c in enumerate(cols):
        aggs[f"_lo{i}"] = F.min(c)
        aggs[f"_hi{i}"] = F.max(c)
    out = with_group_stats(df, group, aggs)
    for i, c in enumerate(cols):
        out = out.withColumn(c + suffix, minmax_expr(F.col(c), F.col(f"_lo{i}"),
                                                     F.col(f"_hi{i}"), constant))
    return out.drop(*aggs.keys())


def minmax_zero(df: DataFrame, group, cols, suffix: str = "") -> DataFrame:
    """Min-max scaling with constant groups -> 0."""
    return minmax(df, group, cols, constant=0.0, suffix=suffix)


def argmax_decision(df: DataFrame, score: str = "NewScore", group: str = AUCTION,
                    out: str = "NewDecision") -> DataFrame:
    """+1 on rows whose score equals the group maximum (ties all +1)."""
    res = with_group_stats(df, group, {"_smax": F.max(score)})
    return res.withColumn(out, F.when(F.col(score) == F.col("_smax"), 1).otherwise(-1)) \
              .drop("_smax")


def normalise_all(df: DataFrame, group: str = AUCTION,
                  exclude: Sequence[str] = (WINNER, DIFF_MIN_PRODUCT, AUCTION, PRODUCT),
                  constant: float = 1.0) -> DataFrame:
    """W6 by auction on every numeric column but the excluded ones,
    in one aggregate and one join."""
    cols = [f.name for f in df.schema.fields
            if f.name not in exclude and f.name != group
            and isinstance(f.dataType, T.NumericType)]
    return minmax(df, group, cols, constant=constant)


def lowest_n_offers(df: DataFrame, n: int = 20, group: str = AUCTION,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """The n lowest landed prices of each auction (ties by
    ``tiebreak`` columns); ``offer_rank`` is 1-based."""
    from pyspark.sql import Window
    w = Window.partitionBy(group).orderBy(F.col(LANDED), *[F.col(c) for c in tiebreak])
    return df.withColumn("offer_rank", F.row_number().over(w)).where(F.col("offer_rank") <= n)


def auction_split_flags(df: DataFrame, ratio: float = 0.3, time_col: str = "Time",
                        group: str = AUCTION) -> DataFrame:
    """(auction, is_test): the first round(ratio * n) auctions in
    (time, name) order are the test set (half-even rounding); whole
    auctions stay on one side.  The order is an exact distributed rank,
    not a single-partition window."""
    from bidscope.operators.ranking import global_rank_count
    auctions = df.groupBy(group).agg(F.min(time_col).alias("_t"))
    ranked, n = global_rank_count(auctions, ["_t", group], "_r")
    n_test = round(ratio * n)            # Python round: half to even
    return ranked.select(group, (F.col("_r") < F.lit(n_test)).alias("is_test"))


def auction_order_split(df: DataFrame, ratio: float = 0.3, time_col: str = "Time",
                        group: str = AUCTION) -> tuple[DataFrame, DataFrame]:
    """(train, test) offers split by auction order."""
    flags = auction_split_flags(df, ratio, time_col, group)
    tagged = df.join(flags, on=group, how="inner")
    return (tagged.where(~F.col("is_test")).drop("is_test"),
            tagged.where(F.col("is_test")).drop("is_test"))


def gower_to_ideal(df: DataFrame, group: str = AUCTION,
                   min_cols: Sequence[str] = (LANDED, MAX_HOURS),
                   max_cols: Sequence[str] = ("SellerFeedbackCount",),
                   one_cols: Sequence[str] = ("IsFulfilledByAmazon", "IsFeaturedMerchant"),
                   zero_cols: Sequence[str] = (COMPETES_PLATFORM,),
                   out: str = "GowerToIdeal") -> DataFrame:
    """Gower dissimilarity of each offer to its auction's ideal profile.

    Ideal: min of ``min_cols``, max of ``max_cols``, 1 for ``one_cols``,
    0 for ``zero_cols``.  Per column (range over the auction plus the
    ideal row): both values scaled by the column max (0 if the max is 0),
    |diff| / (1 - min/max) (0 if that range is 0); nulls weigh 0; the
    distance is the weighted mean.  One group aggregate, no self join.
    """
    spec = ([(c, "min") for c in min_cols] + [(c, "max") for c in max_cols]
            + [(c, "one") for c in one_cols] + [(c, "zero") for c in zero_cols])
    aggs = {}
    for i, (c, _) in enumerate(spec):
        aggs[f"_gmn{i}"] = F.min(F.col(c).cast("double"))
        aggs[f"_gmx{i}"] = F.max(F.col(c).cast("double"))
    res = with_group_stats(df, group, aggs)
    num, den = F.lit(0.0), F.lit(0.0)
    for i, (c, kind) in enumerate(spec):
        gmn, gmx = F.col(f"_gmn{i}"), F.col(f"_gmx{i}")
        ideal = {"min": gmn, "max": gmx, "one": F.lit(1.0), "zero": F.lit(0.0)}[kind]
        mx = F.greatest(gmx, ideal)
        mn = F.least(gmn, ideal)
        rng = F.when(mx == 0, F.lit(0.0)).otherwise(F.lit(1.0) - mn / mx)
        x = F.col(c).cast("double")
        xs = F.when(mx != 0, x / mx).otherwise(F.lit(0.0))
        vs = F.when(mx != 0, ideal / mx).otherwise(F.lit(0.0))
        sij = F.when(rng != 0, F.abs(xs - vs) / rng).otherwise(F.lit(0.0))
        wij = F.when(x.isNull(), F.lit(0.0)).otherwise(F.lit(1.0))
        num = num + F.coalesce(sij, F.lit(0.0)) * wij
        den = den + wij
    return res.withColumn(out, F.when(den != 0, num / den).otherwise(F.lit(0.0))).drop(*aggs.keys())
