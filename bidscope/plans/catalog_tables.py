"""Queries for cleaning (F*), group-relative features (W*), aggregates (A*)
and joins (J*) over the auction view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.scalars import landed_price, ship_hours_floor
from bidscope.operators import clean as C
from bidscope.operators import features as W
from bidscope.operators import metrics as A
from bidscope.operators.events import drop_auctions
from bidscope.operators.ranking import describe
from bidscope.plans.catalog import KEY, KEY_SQL, LANDED_SQL, query
from bidscope.plans.minimum_slice import scored_offers
from bidscope.schema import AUCTION, LANDED, MAX_HOURS, PRODUCT, WINNER

R = 6

# ------------------------------------------------------------ stand-in inputs
# Columns the offers schema has but the driver tables lack, filled by a
# fixed rule from the view (input building only; the operators do the work).

STANDIN_SQL = """
st as (select l_orderkey, l_linenumber, MarketplaceId, ProductId, SellerId, CompetitionName,
  IsBuyBoxWinner, IsFulfilledByAmazon, IsFeaturedMerchant, ListingPrice, ShippingPrice,
  ShippingTime_maxHours, s_acctbal, IsCustomer, ListingPrice as ListingPriceCopy,
  1 as ShipsDomestically, cast(null as varchar) as ConditionNotes,
  case when l_linenumber = 1 then 'new' end as SubCondition from offers)"""

STANDIN_COLS = ["l_orderkey", "l_linenumber", "MarketplaceId", "ProductId", "SellerId",
                "CompetitionName", "IsBuyBoxWinner", "IsFulfilledByAmazon", "IsFeaturedMerchant",
                "ListingPrice", "ShippingPrice", "ShippingTime_maxHours", "s_acctbal", "IsCustomer",
                "ListingPriceCopy", "ShipsDomestically", "ConditionNotes", "SubCondition"]


def standin(offers: DataFrame) -> DataFrame:
    return offers.select(
        *STANDIN_COLS[:14], F.col("ListingPrice").alias("ListingPriceCopy"),
        F.lit(1).alias("ShipsDomestically"), F.lit(None).cast("string").alias("ConditionNotes"),
        F.when(F.col("l_linenumber") == 1, F.lit("new")).alias("SubCondition"))


def _union_report(cols, expr_fn, name_col="column") -> str:
    parts = [f"select '{c}' as {name_col}, {expr_fn(c)} from st" for c in cols]
    return "\nunion all\n".join(parts)


# families of the stand-in columns (ids protected)
_INTEGRAL = ["l_orderkey", "l_linenumber", "IsBuyBoxWinner", "IsFulfilledByAmazon",
             "IsFeaturedMerchant", "ShippingTime_maxHours", "IsCustomer", "ShipsDomestically"]
_FLOATING = ["ListingPrice", "ShippingPrice", "s_acctbal", "ListingPriceCopy"]
_STRING = ["ConditionNotes", "SubCondition"]


def _dup_sql() -> str:
    parts = []
    for fam in (_INTEGRAL, _FLOATING, _STRING):
        for i, c in enumerate(fam):
            later = fam[i + 1:]
            if fam is _STRING:
                terms = [f"coalesce(bool_and({c} is not distinct from {d}), true)" for d in later]
            else:
                terms = [f"coalesce(bool_and(coalesce({c} = {d}, false)), true)" for d in later]
            e = " or ".join(terms) if terms else "coalesce(bool_and(false), false)"
            parts.append(f"select '{c}' as column, ({e}) as duplicate from st")
    return "\nunion all\n".join(parts)


@query("f1_duplicate_columns", f"with {STANDIN_SQL.strip()}\n{_dup_sql()}")
def q_f1(offers):
    """which columns equal a later same-typed column (last copy survives)."""
    return C.duplicate_column_report(standin(offers))


@query("f2_drop_duplicate_rows", """
select distinct MarketplaceId, ProductId, IsBuyBoxWinner, IsFeaturedMerchant, ShippingTime_maxHours
from offers""")
def q_f2(offers):
    """full-row distinct."""
    return C.drop_duplicate_rows(offers.select("MarketplaceId", "ProductId", "IsBuyBoxWinner",
                                               "IsFeaturedMerchant", "ShippingTime_maxHours"))


def _const_expr(c):
    if c in ("MarketplaceId", "ProductId", "SellerId", "CompetitionName", "IsBuyBoxWinner"):
        return "coalesce(bool_and(false), false) as constant"
    return (f"coalesce(count({c}) = 0 or (count({c}) = count(*) and min({c}) = max({c})), false)"
            " as constant")


@query("f3_constant_columns", f"with {STANDIN_SQL.strip()}\n{_union_report(STANDIN_COLS, _const_expr)}")
def q_f3(offers):
    """single-valued columns (null counted as a value; ids, label kept)."""
    return C.constant_column_report(standin(offers))


def _sparse_expr(c):
    return (f"count({c}) as non_null, cast(floor(count(*)*0.9::double) as bigint) as threshold, "
            f"count({c}) >= cast(floor(count(*)*0.9::double) as bigint) as kept")


@query("f4_sparse_columns", f"with {STANDIN_SQL.strip()}\n{_union_report(STANDIN_COLS, _sparse_expr)}")
def q_f4(offers):
    """columns with fewer than int(0.9 n) non-null values are dropped."""
    return C.sparse_column_report(standin(offers))


@query("f5_exactly_one_winner", f"""
select {KEY_SQL}, IsBuyBoxWinner from offers where CompetitionName in (
  select CompetitionName from offers group by 1
  having sum(case when IsBuyBoxWinner = 1 then 1 else 0 end) = 1)""")
def q_f5(offers):
    """offers of auctions with exactly one winner."""
    return C.exactly_one_winner(offers).select(*KEY, WINNER)


@query("f6_exactly_one_customer", f"""
select {KEY_SQL}, IsCustomer from offers where CompetitionName in (
  select CompetitionName from offers group by 1
  having sum(case when IsCustomer = 1 then 1 else 0 end) = 1)""")
def q_f6(offers):
    """offers of auctions with exactly one customer row."""
    kept, _ = C.exactly_one_customer(offers)
    return kept.select(*KEY, "IsCustomer")


TIME_SQL = "(epoch_ms(auction_time) - epoch_ms(timestamp '2016-01-01'))/1000.0::double"


def with_time(offers: DataFrame) -> DataFrame:
    """Stand-in Time: seconds since 2016 of the auction time."""
    from bidscope.functions.scalars import seconds_since_2016_ts
    return offers.withColumn("Time", seconds_since_2016_ts("auction_time"))


@query("f7_winners", f"""
select CompetitionName as File, SellerId as WinnerId, round({TIME_SQL}, {R}) as Time,
  MarketplaceId, ProductId, IsCustomer, round(ListingPrice+ShippingPrice, {R}) as LandedPrice
from offers where IsBuyBoxWinner = 1""")
def q_f7(offers):
    """winning rows, renamed."""
    return C.winners(with_time(offers))


@query("f8_drop_null_rows", f"""
select {KEY_SQL}, round(nullif(ShippingPrice, 0), {R}) as ShippingPrice,
  case when IsFeaturedMerchant = 1 then 'new' end as SubCondition
from offers where nullif(ShippingPrice, 0) is not null and IsFeaturedMerchant = 1""")
def q_f8(offers):
    """F8: rows with any null removed."""
    src = offers.select(*KEY, F.nullif(F.col("ShippingPrice"), F.lit(0.0)).alias("ShippingPrice"),
                        F.when(F.col("IsFeaturedMerchant") == 1, F.lit("new")).alias("SubCondition"))
    return C.drop_null_rows(src)


@query("f9_known_markets", f"""
select {KEY_SQL}, MarketplaceId from offers where MarketplaceId like 'Brand#1%'""")
def q_f9(offers):
    """offers of markets with a platform seller (dimension: Brand#1x markets)."""
    dim = W.derived_platform_dimension(offers.where(F.col("MarketplaceId").startswith("Brand#1")))
    return W.known_markets(offers, dim).select(*KEY, "MarketplaceId")


@query("f11_reject_outliers", f"""
with {LANDED_SQL},
m as (select *, median(LandedPrice) over (partition by ProductId) as med from lp),
d as (select *, abs(LandedPrice - med) as dev from m),
s as (select *, median(dev) over (partition by ProductId) as mad from d)
select {KEY_SQL}, round(LandedPrice, {R}) as LandedPrice from s where mad = 0 or dev / mad < 2""")
def q_f11(offers):
    """per-product outlier rejection, |x - median| / MAD < 2 (exact medians)."""
    return C.reject_outliers(landed_price(offers), LANDED, (PRODUCT,), 2.0).select(*KEY, LANDED)


_F12_KEEP = [c for c in STANDIN_COLS if c not in ("ListingPrice", "ShipsDomestically",
                                                  "ConditionNotes", "SubCondition")]


@query("f12_clean", f"""
with {STANDIN_SQL.strip()},
d as (select distinct {", ".join(_F12_KEEP)} from st),
one as (select CompetitionName from d group by 1
        having sum(case when IsBuyBoxWinner = 1 then 1 else 0 end) = 1)
select {", ".join(c if c not in ("ShippingPrice", "s_acctbal", "ListingPriceCopy") else f"round({c}, {R}) as {c}" for c in _F12_KEEP)}
from d where CompetitionName in (select CompetitionName from one)""")
def q_f12(offers):
    """F1 -> F2 -> F3 -> F4 -> F5 on the stand-in offers."""
    return C.clean(standin(offers))


def _dense_expr(c):
    return f"count({c}) < cast(floor(count(*)*0.9::double) as bigint) as sparse"


def _names(flag: str) -> str:
    return f"(select coalesce(string_agg(name, ',' order by i), '') from v where {flag})"


def _number(*flags: str) -> str:
    return f"(select count(*) from v where not ({' or '.join(flags)}))" if flags else "(select count(*) from v)"


_F14_STEPS = [("duplicate_columns", "n0", "n0", [], ["gone1"]), ("duplicate_rows", "n0", "n2", ["gone1"], ["gone1"]),
              ("constant_columns", "n2", "n2", ["gone1"], ["gone1", "gone2"]),
              ("sparse_columns", "n2", "n2", ["gone1", "gone2"], ["gone1", "gone2", "gone3"]),
              ("one_winner", "n2", "n5", ["gone1", "gone2", "gone3"], ["gone1", "gone2", "gone3"])]


@query("f14_clean_report", f"""
with {STANDIN_SQL.strip()},
d as (select distinct * from st),
pos as (select * from (values {", ".join(f"('{c}', {i})" for i, c in enumerate(STANDIN_COLS))}) t(name, i)),
dup as ({_dup_sql()}),
con as ({_union_report(STANDIN_COLS, _const_expr)}),
spa as ({_union_report(STANDIN_COLS, _dense_expr).replace(" from st", " from d")}),
v as (select name, i, coalesce(duplicate, false) as gone1, constant and not coalesce(duplicate, false) as gone2,
        sparse and not constant and not coalesce(duplicate, false) as gone3
      from pos left join dup on dup.column = name left join con on con.column = name left join spa on spa.column = name),
one as (select CompetitionName from d group by 1
        having sum(case when IsBuyBoxWinner = 1 then 1 else 0 end) = 1),
n as (select (select count(*) from st) as n0, (select count(*) from d) as n2,
        (select count(*) from d where CompetitionName in (select * from one)) as n5)
""" + "\nunion all\n".join(
    f"select '{step}' as step, cast({b} as bigint) as rows_before, cast({a} as bigint) as rows_after, "
    f"cast({_number(*cb)} as int) as cols_before, cast({_number(*ca)} as int) as cols_after, "
    f"{_names(ca[-1]) if len(ca) > len(cb) else chr(39) * 2} as dropped from n"
    for step, b, a, cb, ca in _F14_STEPS))
def q_f14(offers):
    """rows / columns before and after each cleaning step."""
    return C.clean_report(standin(offers))


# ------------------------------------------------------ W: group-relative

def _lp(offers):
    return landed_price(offers)


@query("w1_diff_to_min_auction", f"""
with {LANDED_SQL}
select {KEY_SQL}, round(LandedPrice - min(LandedPrice) over (partition by CompetitionName), {R})
  as DifftoMinLandedPriceCompetition from lp""")
def q_w1(offers):
    """Landed price minus the auction minimum."""
    return W.diff_to_min_auction(_lp(offers)).select(*KEY, "DifftoMinLandedPriceCompetition")


PLATFORM_SQL = LANDED_SQL + """,
pl as (select lp.*, d.PlatformSellerId from lp join
  (select MarketplaceId, min(SellerId) as PlatformSellerId from offers group by 1) d
  on lp.MarketplaceId = d.MarketplaceId)"""


def _with_platform(offers):
    df = _lp(offers)
    return W.platform_seller(df, W.derived_platform_dimension(offers))


@query("w2_competes_with_platform", f"""
with {PLATFORM_SQL}
select {KEY_SQL}, case when SellerId = PlatformSellerId then 0
  when max(case when SellerId = PlatformSellerId then 1 else 0 end) over (partition by CompetitionName) = 1
  then 1 else -1 end as CompeteAmzCompetition from pl""")
def q_w2(offers):
    """Auction contains the platform seller (1 / -1; platform row 0)."""
    return W.competes_with_platform(_with_platform(offers)).select(*KEY, "CompeteAmzCompetition")


@query("w3_diff_to_platform", f"""
with {PLATFORM_SQL},
q as (select *, min(case when SellerId = PlatformSellerId then LandedPrice end)
        over (partition by CompetitionName) as pmin from pl)
select {KEY_SQL}, round(case when pmin is null then -9999 else LandedPrice - pmin end, {R})
  as DifftoAmzLandedPriceCompetition from q""")
def q_w3(offers):
    """W3 + P22: landed minus the platform's landed price; -9999 without one."""
    return W.diff_to_platform(_with_platform(offers)).select(*KEY, "DifftoAmzLandedPriceCompetition")


@query("w4_ideal_point", f"""
with {LANDED_SQL},
h as (select *, case when ShippingTime_maxHours = 0 then 1 else ShippingTime_maxHours end as hrs from lp)
select {KEY_SQL}, round(min(LandedPrice) over w * min(hrs) over w - LandedPrice * hrs, {R})
  as IdealPointCompetition from h window w as (partition by CompetitionName)""")
def q_w4(offers):
    """W4 after P9: min(landed)*min(hours) - landed*hours per auction."""
    df = _lp(offers).withColumn(MAX_HOURS, ship_hours_floor(MAX_HOURS))
    return W.ideal_point(df).select(*KEY, "IdealPointCompetition")


@query("w5_diff_to_min_product", f"""
with {LANDED_SQL}
select {KEY_SQL}, round(LandedPrice - min(LandedPrice) over (partition by ProductId), {R})
  as DifftoMinLandedPriceProduct from lp""")
def q_w5(offers):
    """W5 + A1: landed minus the product minimum (aggregate + join, product skew)."""
    return W.diff_to_min_product(_lp(offers)).select(*KEY, "DifftoMinLandedPriceProduct")


@query("w6_minmax", f"""
select {KEY_SQL}, round(case when max(ListingPrice) over w = min(ListingPrice) over w then 1.0::double
  else (ListingPrice - min(ListingPrice) over w) / (max(ListingPrice) over w - min(ListingPrice) over w)
  end, {R}) as ListingPrice from offers window w as (partition by CompetitionName)""")
def q_w6(offers):
    """Min-max scaling by auction, constant auctions -> 1."""
    return W.minmax(offers, AUCTION, "ListingPrice").select(*KEY, "ListingPrice")


@query("w7_minmax_zero", f"""
select {KEY_SQL}, round(case when max(ListingPrice) over w = min(ListingPrice) over w then 0.0::double
  else (ListingPrice - min(ListingPrice) over w) / (max(ListingPrice) over w - min(ListingPrice) over w)
  end, {R}) as ListingPrice from offers window w as (partition by CompetitionName)""")
def q_w7(offers):
    """Min-max scaling by auction, constant auctions -> 0."""
    return W.minmax_zero(offers, AUCTION, "ListingPrice").select(*KEY, "ListingPrice")


@query("w8_argmax_decision", f"""
with {LANDED_SQL}
select {KEY_SQL}, case when -LandedPrice = max(-LandedPrice) over (partition by CompetitionName)
  then 1 else -1 end as NewDecision from lp""")
def q_w8(offers):
    """+1 on the rows with the auction's best score (score = -landed; ties all +1)."""
    df = _lp(offers).withColumn("score", -F.col(LANDED))
    return W.argmax_decision(df, "score").select(*KEY, "NewDecision")


@query("w10_lowest_n_offers", f"""
with {LANDED_SQL},
r as (select *, row_number() over (partition by CompetitionName
        order by LandedPrice, l_orderkey, l_linenumber, SellerId, l_shipdate) as rk from lp)
select {KEY_SQL}, cast(rk as int) as offer_rank from r where rk <= 20""")
def q_w10(offers):
    """The 20 lowest landed prices of each auction."""
    out = W.lowest_n_offers(_lp(offers), 20,
                            tiebreak=["l_orderkey", "l_linenumber", "SellerId", "l_shipdate"])
    return out.select(*KEY, "offer_rank")


@query("w11_auction_order_split", """
with a as (select CompetitionName, min(auction_time) as t from offers group by 1),
r as (select CompetitionName, row_number() over (order by t, CompetitionName) - 1 as rk,
        count(*) over () as n from a)
select CompetitionName, rk < round_even(0.3::double * n, 0) as is_test from r""")
def q_w11(offers):
    """First round(0.3 n) auctions in (time, name) order are the test side."""
    return W.auction_split_flags(offers, 0.3, "auction_time")


_NORM_COLS = ["IsBuyBoxWinner", "ProductId", "CompetitionName", "IsFulfilledByAmazon",
              "IsFeaturedMerchant", "ListingPrice", "ShippingPrice", "ShippingTime_maxHours",
              "s_acctbal"]


def _norm_sql(c):
    if c in ("IsBuyBoxWinner", "ProductId", "CompetitionName"):
        return c
    return (f"round(case when max({c}) over w = min({c}) over w then 1.0::double else "
            f"({c} - min({c}) over w) / (max({c}) over w - min({c}) over w) end, {R}) as {c}")


@query("w12_normalise_all", f"""
select cast(l_orderkey as varchar) as okey, cast(l_linenumber as varchar) as line,
  {", ".join(_norm_sql(c) for c in _NORM_COLS)}
from offers window w as (partition by CompetitionName)""")
def q_w12(offers):
    """Min-max by auction on every numeric column but label / product / auction."""
    df = offers.select(F.col("l_orderkey").cast("string").alias("okey"),
                       F.col("l_linenumber").cast("string").alias("line"), *_NORM_COLS)
    return W.normalise_all(df)


# ---------------------------------------------------------- A: aggregates

@query("a1_product_minima", f"""
select ProductId, round(min(ListingPrice+ShippingPrice), {R}) as min_landed from offers group by 1""")
def q_a1(offers):
    """A1: min landed price per product."""
    return W.product_minima(_lp(offers))


@query("a2_auction_summary", f"""
select CompetitionName, cast(sum(case when IsBuyBoxWinner=1 then 1 else 0 end) as bigint) as n_winners,
  count(*) as n_offers, cast(sum(case when IsCustomer=1 then 1 else 0 end) as bigint) as n_customers,
  round(min(ListingPrice+ShippingPrice), {R}) as min_landed from offers group by 1""")
def q_a2(offers):
    """A2: winners, offers, customers and min landed per auction."""
    return C.auction_summary(offers)


@query("a3_market_sizes", """
select MarketplaceId, count(*) as n_rows from offers group by rollup (MarketplaceId)""")
def q_a3(offers):
    """A3: rows per market plus the total (rollup)."""
    return A.market_sizes(offers)


@query("a4_distinct_count", """
select count(distinct CompetitionName) as distinct_CompetitionName,
  count(distinct ProductId) as distinct_ProductId, count(distinct MarketplaceId) as distinct_MarketplaceId,
  count(distinct SellerId) as distinct_SellerId from offers""")
def q_a4(offers):
    """A4: distinct auctions, products, markets, sellers."""
    return A.distinct_count(offers, ["CompetitionName", "ProductId", "MarketplaceId", "SellerId"])


_SKETCHED = ["CompetitionName", "ProductId", "MarketplaceId", "SellerId"]


@query("a4_sketched_distinct", "\nunion all\n".join(
    f"select '{c}' as \"column\", count(distinct {c}) as n_values, true as within_four_errors from offers" for c in _SKETCHED))
def q_a4_sketched(offers):
    """A4 approximate: sketches kept per market, merged on read, within four standard errors of the count."""
    kept = A.distinct_sketches(offers, _SKETCHED, ["MarketplaceId"])
    exact = A.distinct_count(offers, _SKETCHED)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"distinct_{c}").alias("n_values")) for c in _SKETCHED]))
    bound = 4 * A.HLL_ERROR / 2 ** 6
    return (exact.select(each.alias("e")).select("e.*").join(A.union_distinct(kept), "column")
            .select("column", "n_values", (F.abs(F.col("n_distinct") - F.col("n_values")) <= F.lit(bound) * F.col("n_values")).alias("within_four_errors")))


@query("a8_describe", f"""
with {LANDED_SQL}
select MarketplaceId, count(LandedPrice) as count, round(avg(LandedPrice), {R}) as mean,
  round(stddev_samp(LandedPrice), {R}) as std, round(min(LandedPrice), {R}) as min,
  round(quantile_cont(LandedPrice, 0.25), {R}) as p25, round(quantile_cont(LandedPrice, 0.5), {R}) as p50,
  round(quantile_cont(LandedPrice, 0.75), {R}) as p75, round(max(LandedPrice), {R}) as max
from lp group by 1""")
def q_a8(offers):
    """Describe landed price per market (exact interpolated quartiles)."""
    return describe(_lp(offers), LANDED, ["MarketplaceId"])


@query("a9_histogram", f"""
with {LANDED_SQL}
select cast(floor((LandedPrice - 0) / 100.0::double) as bigint) as bin, count(*) as n,
  round(0 + cast(floor((LandedPrice - 0) / 100.0::double) as bigint) * 100.0::double, {R}) as bin_lo
from lp group by 1""")
def q_a9(offers):
    """Landed price histogram, bins of width 100 from 0."""
    return A.histogram(_lp(offers), LANDED, 0.0, 100.0)


_CORR = ["ListingPrice", "ShippingPrice", "ShippingTime_maxHours", "s_acctbal"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(_CORR):
        for b in _CORR[i + 1:]:
            parts.append(f"select MarketplaceId, '{a}' as a, '{b}' as b, round(corr({a}, {b}), {R}) as corr "
                         f"from offers group by MarketplaceId")
    return "\nunion all\n".join(parts)


@query("a10_feature_correlation", _corr_sql())
def q_a10(offers):
    """A10: Pearson correlation of feature pairs per market."""
    return A.feature_correlation(offers, _CORR)


# ------------------------------------------------------------- J: joins

@query("j2_anti_join", f"""
select {KEY_SQL} from offers where CompetitionName not in (
  select CompetitionName from offers group by 1
  having sum(case when IsBuyBoxWinner=1 then 1 else 0 end) <> 1)""")
def q_j2(offers):
    """Remove auctions on the bad list (not exactly one winner) by anti join."""
    return drop_auctions(offers, C.bad_auctions(offers)).select(*KEY)


@query("j3_diff_to_product_min_given", f"""
with {LANDED_SQL},
mins as (select ProductId, min(LandedPrice) as m from lp where year(l_shipdate) < 1995 group by 1),
q as (select lp.*, coalesce(mins.m, min(LandedPrice) over (partition by lp.ProductId)) as pm
      from lp left join mins on lp.ProductId = mins.ProductId)
select {KEY_SQL}, round(LandedPrice - pm, {R}) as DifftoMinLandedPriceProduct from q""")
def q_j3(offers):
    """Diff to supplied product minima (learned on pre-1995 offers); unseen
    products fall back to their own minimum."""
    df = _lp(offers)
    minima = W.product_minima(df.where(F.year("l_shipdate") < 1995))
    return W.diff_to_min_product(df, minima).select(*KEY, "DifftoMinLandedPriceProduct")


@query("j4_product_history_min", f"""
with {LANDED_SQL},
h as (select ProductId, min(LandedPrice) as hm from lp where year(l_shipdate) < 1995 group by 1),
a as (select CompetitionName, ProductId, min(LandedPrice) as am from lp group by 1, 2)
select CompetitionName, round(coalesce(hm, am), {R}) as ProductMinPrice
from a left join h on a.ProductId = h.ProductId""")
def q_j4(offers):
    """Product minimum over a history table (pre-1995), else the auction minimum."""
    from bidscope.operators.reprice import product_history_min
    hist = product_history_min(offers.where(F.year("l_shipdate") < 1995))
    a = _lp(offers).groupBy(AUCTION, PRODUCT).agg(F.min(LANDED).alias("am"))
    return (a.join(hist, on=PRODUCT, how="left")
             .select(AUCTION, F.coalesce("ProductMinPrice", "am").alias("ProductMinPrice")))


@query("j9_gower_to_ideal", f"""
with {PLATFORM_SQL},
c as (select *, case when SellerId = PlatformSellerId then 0
  when max(case when SellerId = PlatformSellerId then 1 else 0 end) over (partition by CompetitionName) = 1
  then 1 else -1 end as Cmp from pl),
g as (select *,
  min(LandedPrice) over w as l_mn, max(LandedPrice) over w as l_mx,
  min(ShippingTime_maxHours) over w as h_mn, max(ShippingTime_maxHours) over w as h_mx,
  min(s_acctbal) over w as f_mn, max(s_acctbal) over w as f_mx,
  min(IsFulfilledByAmazon) over w as a_mn, max(IsFulfilledByAmazon) over w as a_mx,
  min(IsFeaturedMerchant) over w as m_mn, max(IsFeaturedMerchant) over w as m_mx,
  min(Cmp) over w as c_mn, max(Cmp) over w as c_mx
  from c window w as (partition by CompetitionName)),
t as (select *,
  {{TERM_L}} + {{TERM_H}} + {{TERM_F}} + {{TERM_A}} + {{TERM_M}} + {{TERM_C}} as num from g)
select {KEY_SQL}, round(num / 6.0::double, {R}) as GowerToIdeal from t""")
def q_j9(offers):
    """Gower distance of each offer to its auction's ideal profile."""
    df = W.competes_with_platform(_with_platform(offers))
    return W.gower_to_ideal(df, max_cols=("s_acctbal",)).select(*KEY, "GowerToIdeal")


def _gower_term(x: str, mn: str, mx: str, ideal_kind: str) -> str:
    ideal = {"min": mn, "max": mx, "one": "1.0::double", "zero": "0.0::double"}[ideal_kind]
    gmx = f"greatest({mx}, {ideal})"
    gmn = f"least({mn}, {ideal})"
    rng = f"(case when {gmx} = 0 then 0.0::double else 1.0::double - {gmn}/{gmx} end)"
    xs = f"(case when {gmx} <> 0 then {x}/{gmx} else 0.0::double end)"
    vs = f"(case when {gmx} <> 0 then {ideal}/{gmx} else 0.0::double end)"
    return f"(case when {rng} <> 0 then abs({xs} - {vs}) / {rng} else 0.0::double end)"


def _fix_j9():
    from bidscope.plans.catalog import ORACLES
    sql = ORACLES["j9_gower_to_ideal"]
    terms = {
        "{TERM_L}": _gower_term("LandedPrice", "l_mn", "l_mx", "min"),
        "{TERM_H}": _gower_term("ShippingTime_maxHours", "h_mn", "h_mx", "min"),
        "{TERM_F}": _gower_term("s_acctbal", "f_mn", "f_mx", "max"),
        "{TERM_A}": _gower_term("IsFulfilledByAmazon", "a_mn", "a_mx", "one"),
        "{TERM_M}": _gower_term("IsFeaturedMerchant", "m_mn", "m_mx", "one"),
        "{TERM_C}": _gower_term("Cmp", "c_mn", "c_mx", "zero"),
    }
    for k, v in terms.items():
        sql = sql.replace(k, v)
    ORACLES["j9_gower_to_ideal"] = sql


_fix_j9()


# ---------------------------------------------- A on the minimum slice

@query("a7_classification_report", f"""
with {{SLICE}},
c as (select x as label,
        sum(case when IsBuyBoxWinner=x and NewDecision=x then 1 else 0 end)::double as tp,
        sum(case when NewDecision=x then 1 else 0 end)::double as pp,
        sum(case when IsBuyBoxWinner=x then 1 else 0 end)::double as ap
      from s5, (values (-1),(1)) t(x) group by x),
m as (select label, case when pp>0 then tp/pp else 0 end as pr,
             case when ap>0 then tp/ap else 0 end as rc, ap from c),
f as (select label, pr, rc, case when pr+rc>0 then 2*pr*rc/(pr+rc) else 0 end as f1, ap from m)
select cast(label as varchar) as label, round(pr,{R}) as precision, round(rc,{R}) as recall,
  round(f1,{R}) as f1, cast(ap as bigint) as support from f
union all
select 'avg / total', round(sum(pr*ap)/sum(ap),{R}), round(sum(rc*ap)/sum(ap),{R}),
  round(sum(f1*ap)/sum(ap),{R}), cast(sum(ap) as bigint) from f""")
def q_a7(offers):
    """Classification report (+ support-weighted average) of the minimum slice."""
    return A.classification_report(scored_offers(offers), WINNER, "NewDecision")


@query("a12_f1_product", f"""
with {{SLICE}},
c as (select x as label,
        sum(case when IsBuyBoxWinner=x and NewDecision=x then 1 else 0 end)::double as tp,
        sum(case when NewDecision=x then 1 else 0 end)::double as pp,
        sum(case when IsBuyBoxWinner=x then 1 else 0 end)::double as ap
      from s5, (values (-1),(1)) t(x) group by x),
m as (select case when pp>0 then tp/pp else 0 end as pr, case when ap>0 then tp/ap else 0 end as rc from c),
f as (select case when pr+rc>0 then 2*pr*rc/(pr+rc) else 0 end as f1 from m)
select round(case when min(f1) <= 0 then 0 else exp(sum(ln(f1))) end, {R}) as f1_product from f""")
def q_a12(offers):
    """Product of per-class F1 of the minimum slice."""
    sc = A.class_scores(scored_offers(offers), WINNER, "NewDecision")
    return A.f1_product(sc)


def _fix_slice():
    from bidscope.plans.catalog import ORACLES
    from bidscope.plans.catalog_core import SLICE_SQL
    for k in ("a7_classification_report", "a12_f1_product"):
        ORACLES[k] = ORACLES[k].replace("{SLICE}", SLICE_SQL.strip())


_fix_slice()
