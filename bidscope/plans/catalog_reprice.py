"""Queries for win events (W9, F10, R1, J1, J5), repricing (R2-R10, K1,
K2, U1, U3) and feature pipelines (FP1-FP3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.scalars import landed_price
from bidscope.operators import features as W
from bidscope.operators import reprice as RP
from bidscope.operators.clean import became_customer, winners
from bidscope.operators.events import offers_of_events, previous_win, select_reprice_events
from bidscope.plans import features as FP
from bidscope.plans.catalog import CONTEXT_SQL, KEY, KEY_SQL, query, sql_grid
from bidscope.plans.reprice_jobs import backtest_summary, reprice_many, reprice_models
from bidscope.schema import AUCTION, LANDED
from bidscope.session import cut_lineage

R = 6
TIEBREAK = ["l_orderkey", "l_linenumber", "l_shipdate"]

# ----------------------------------------------------------- events

EVENTS_SQL = """
wn as (select CompetitionName as File, SellerId as WinnerId, auction_time as Time, MarketplaceId,
   ProductId, IsCustomer, ListingPrice+ShippingPrice as LandedPrice, l_orderkey, l_linenumber, l_shipdate
  from offers where IsBuyBoxWinner = 1),
ev as (select MarketplaceId, WinnerId, ProductId,
   lag(File) over o as File, lag(Time) over o as PTime, lag(IsCustomer) over o as IsCustomer,
   lag(LandedPrice) over o as LandedPrice, IsCustomer as Next, File as NextId, LandedPrice as NextPrice
  from wn window o as (partition by MarketplaceId, WinnerId, ProductId
                       order by Time, File, l_orderkey, l_linenumber, l_shipdate)),
pairs as (select * from ev where File is not null and PTime is not null and IsCustomer is not null
          and LandedPrice is not null),
events as (select File, LandedPrice, NextId, NextPrice from pairs where IsCustomer = 0 and Next = 1)"""


def _wins(offers: DataFrame) -> DataFrame:
    return winners(offers.withColumn("Time", F.col("auction_time")), carry=TIEBREAK)


def _pairs(offers: DataFrame) -> DataFrame:
    return previous_win(_wins(offers), ["Time", "File", *TIEBREAK])


def _events(offers: DataFrame) -> DataFrame:
    return select_reprice_events(offers, "auction_time", TIEBREAK)


@query("w9_previous_win", f"""
with {EVENTS_SQL.strip()}
select MarketplaceId, WinnerId, ProductId, File, cast(PTime as varchar) as Time, IsCustomer,
  round(LandedPrice, {R}) as LandedPrice, Next, NextId, round(NextPrice, {R}) as NextPrice from pairs""")
def q_w9(offers):
    """Previous win of the same (market, winner, product) in time order."""
    return _pairs(offers).withColumn("Time", F.date_format("Time", "yyyy-MM-dd HH:mm:ss"))


@query("f10_became_customer", f"""
with {EVENTS_SQL.strip()}
select MarketplaceId, WinnerId, ProductId, File, IsCustomer, round(LandedPrice, {R}) as LandedPrice,
  Next, NextId, round(NextPrice, {R}) as NextPrice from pairs where IsCustomer = 0 and Next = 1""")
def q_f10(offers):
    """previous win not ours, this win ours."""
    return became_customer(_pairs(offers)).drop("Time")


@query("r1_select_reprice_events", f"""
with {EVENTS_SQL.strip()}
select File, round(LandedPrice, {R}) as LandedPrice, NextId, round(NextPrice, {R}) as NextPrice from events""")
def q_r1(offers):
    """F7 -> W9 -> F10: (File, LandedPrice, NextId, NextPrice)."""
    return _events(offers)


@query("j1_semi_join", f"""
with {EVENTS_SQL.strip()}
select {KEY_SQL} from offers where CompetitionName in (select File from events)""")
def q_j1(offers):
    """Offers of the auctions on the reprice list (left semi join)."""
    return offers_of_events(offers, _events(offers)).select(*KEY)


# --------------------------------------------------------- reprice chain SQL

def _mm(c: str) -> str:
    return (f"(case when max({c}) over w = min({c}) over w then 1.0::double else "
            f"({c} - min({c}) over w)/(max({c}) over w - min({c}) over w) end)")


def _r2(c: str, scale: str = "100.0") -> str:
    return f"(round_even({c}*{scale}::double, 0)/{scale}::double)"


def reprice_sql(p: str, prob: str, only: str | None = None) -> str:
    """DuckDB CTEs of R2 -> R5 (degree-1 smoothing) prefixed ``p``; ``only``
    restricts to auctions listed by a subquery."""
    where = f"where CompetitionName in ({only})" if only else ""
    return f"""
{p}one as (select CompetitionName from lp {where} group by 1
           having sum(case when IsCustomer=1 then 1 else 0 end)=1),
{p}hist as (select ProductId, min(LandedPrice) as hm from lp group by 1),
{p}c2 as (select lp.*, b.WinnerPrice, b.CustomerPrice, b.CustomerStatus, b.MinPrice, b.lo, b.hi, b.mid,
          coalesce(h.hm, b.MinPrice) as ProductMinPrice
       from lp join bnd b on lp.CompetitionName = b.CompetitionName
       left join {p}hist h on lp.ProductId = h.ProductId
       where lp.CompetitionName in (select CompetitionName from {p}one)),
{p}g as (select *, {sql_grid('lo', 'mid', 'hi')} as grid from {p}c2 where IsCustomer = 1),
{p}g2 as (select *, unnest(grid) as cprice from {p}g),
{p}fr as (select *, false as is_candidate from {p}c2
          union all by name
          select * exclude (grid, cprice, LandedPrice), cprice as LandedPrice, true as is_candidate
          from {p}g2),
{p}f1 as (select *, case when ShippingTime_maxHours=0 then 1 else ShippingTime_maxHours end as hh,
          LandedPrice - ProductMinPrice as DifftoMinLandedPriceProduct from {p}fr),
{p}f2 as (select *, min(LandedPrice) over w * min(hh) over w - LandedPrice*hh as ip
          from {p}f1 window w as (partition by CompetitionName)),
{p}f3 as (select *, {_mm('ip')} as ipn, {_mm('LandedPrice')} as ldn, {_mm('DifftoMinLandedPriceProduct')} as dpn
          from {p}f2 window w as (partition by CompetitionName)),
{p}f4 as (select *, IsFulfilledByAmazon*({prob}) + ({prob})*ipn + ({prob})*IsFeaturedMerchant as ns,
          exp(-((LandedPrice-WinnerPrice)*(LandedPrice-WinnerPrice))/2.0::double)
            / sqrt(2.0::double*pi()) as wt from {p}f3),
{p}f5 as (select *, {_mm('ns')} as nsn, {_mm('wt')} as wtn from {p}f4
          window w as (partition by CompetitionName)),
{p}f6 as (select *, nsn + wtn as bl from {p}f5),
{p}sc as (select *, {_mm('bl')} * 100.0::double as Score from {p}f6
          window w as (partition by CompetitionName)),
{p}cand as (select CompetitionName, LandedPrice as Price, Score from {p}sc where is_candidate),
{p}fit as (select *, regr_slope(Score, Price) over w as b1, regr_intercept(Score, Price) over w as b0
           from {p}cand window w as (partition by CompetitionName)),
{p}sm as (select CompetitionName, Price, Score, least(greatest(
            (case when b1 is null or isnan(b1) then 0.0::double else b1 end)*Price
            + (case when b0 is null or isnan(b0) then Score else b0 end), 0.0::double), 100.0::double)
            as Smoothed from {p}fit),
{p}ctx as (select CompetitionName, CustomerPrice, WinnerPrice, CustomerStatus from {p}c2
           where IsCustomer = 1),
{p}t as (select s.CompetitionName, {_r2('Price')} as Price, {_r2('Smoothed')} as PredictedScore,
          c.CustomerPrice, c.WinnerPrice, c.CustomerStatus from {p}sm s
          left join {p}ctx c on s.CompetitionName = c.CompetitionName),
{p}t2 as (select *, case when {_r2('Price', '1000.0')} > {_r2('CustomerPrice', '1000.0')} then 'UP'
          when {_r2('Price', '1000.0')} < {_r2('CustomerPrice', '1000.0')} then 'DOWN' else 'KEEP' end
          as Direction from {p}t),
{p}top as (select *, row_number() over (partition by CompetitionName
           order by PredictedScore desc, Price asc) as rank from {p}t2),
{p}rec as (select CompetitionName, CompetitionName as File, CustomerPrice, WinnerPrice, CustomerStatus,
           Price as RecommendedPrice, PredictedScore, Direction from {p}top where rank = 1)"""


HALF = "0.5::double"
FEAT = "(0.25::double + 0.5::double*IsFeaturedMerchant)"


def _half():
    return F.lit(0.5)


def _feat():
    return F.lit(0.25) + F.lit(0.5) * F.col("IsFeaturedMerchant")


def _frame(offers):
    return RP.make_candidates(offers)


@query("r2_make_candidates", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, l_orderkey, l_linenumber, SellerId, is_candidate,
  round(LandedPrice, {R}) as LandedPrice, round(DifftoMinLandedPriceProduct, {R}) as DifftoMinLandedPriceProduct
from a_f1""")
def q_r2(offers):
    """R2: real offers + grid candidates (copies of the customer row) per auction."""
    return _frame(offers).select(AUCTION, "l_orderkey", "l_linenumber", "SellerId", "is_candidate",
                                 LANDED, "DifftoMinLandedPriceProduct")


@query("u1_union_candidates", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, is_candidate, count(*) as n from a_fr group by 1, 2""")
def q_u1(offers):
    """Union by name of candidates and real offers, counted per auction."""
    return _frame(offers).groupBy(AUCTION, "is_candidate").agg(F.count(F.lit(1)).alias("n"))


@query("r3_score_candidates", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, l_orderkey, l_linenumber, SellerId, is_candidate,
  round(LandedPrice, {R}) as LandedPrice, round(Score, {R}) as Score from a_sc""")
def q_r3(offers):
    """Scores of all rows of each auction (candidates included), prob 0.5."""
    sc = RP.unpack(RP.score_candidates(RP.pack_candidates(offers), _half()))
    return sc.select(AUCTION, "l_orderkey", "l_linenumber", "SellerId", "is_candidate", LANDED, "Score")


@query("r4_smooth_curve_linear", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, round(Price, {R}) as Price, round(Score, {R}) as Score,
  round(Smoothed, 4) as Smoothed from a_sm""")
def q_r4(offers):
    """R4 with degree 1: least-squares line of score on price per auction,
    clipped (fit compared at 1e-4: the engines accumulate sums differently)."""
    sc = RP.score_candidates(RP.pack_candidates(offers), _half())
    return RP.smooth_curve(sc, (AUCTION,), 1).withColumn("Smoothed", F.round("Smoothed", 4))


@query("r4_smooth_curve_poly5")
def q_r4p(offers):
    """R4 with degree 5: NumPy polyfit per auction via mapInPandas (rows-only check)."""
    sc = RP.score_candidates(RP.pack_candidates(offers), _half())
    return RP.smooth_curve(sc, (AUCTION,), 5)


def orthogonal_sql(source: str, degree: int = RP.POLY_DEGREE) -> str:
    """DuckDB CTEs of the degree-``degree`` curve over ``source`` (CompetitionName, Price, Score),
    by polynomials that are orthogonal over each auction's prices; the last is ``o_sm``."""
    w = "window w as (partition by CompetitionName)"
    parts = [f"""
o_x as (select *, min(Price) over w as lo, max(Price) over w as hi, cast(count(*) over w as double) as n,
  avg(Score) over w as f from {source} {w}),
o_t as (select *, case when hi > lo then (2.0::double*Price - lo - hi)/(hi - lo) else 0.0::double end as t from o_x),
o_0 as (select CompetitionName, Price, Score, t, 1e-20::double*n as least_, f, 1.0::double as p, 0.0::double as q,
  n as pp, 1.0::double as qq, sum(t) over w as tp from o_t {w})"""]
    for k in range(degree):
        parts.append(f"""
o_{k}n as (select *, case when pp > least_ then (t - tp/pp)*p{" - pp/qq*q" if k else ""} else 0.0::double end as nw from o_{k}),
o_{k}s as (select *, sum(nw*nw) over w as nn, sum(Score*nw) over w as yn, sum(t*nw*nw) over w as tn from o_{k}n {w}),
o_{k + 1} as (select CompetitionName, Price, Score, t, least_, f + case when nn > least_ then nw*yn/nn else 0.0::double end as f,
  nw as p, p as q, nn as pp, pp as qq, tn as tp from o_{k}s)""")
    parts.append(f"""
o_sm as (select CompetitionName, Price, Score, least(greatest(f, 0.0::double), 100.0::double) as Smoothed from o_{degree})""")
    return ",".join(parts)


@query("r4_smooth_curve_orthogonal", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)},{orthogonal_sql('a_cand')}
select CompetitionName, round(Price, {R}) as Price, round(Score, {R}) as Score, round(Smoothed, 4) as Smoothed from o_sm""")
def q_r4o(offers):
    """R4 with degree 5 as expressions: orthogonal polynomials over each auction's prices (compared at 1e-4)."""
    sc = RP.score_candidates(RP.pack_candidates(offers), _half())
    return RP.smooth_curve(sc, (AUCTION,), 5, orthogonal=True).withColumn("Smoothed", F.round("Smoothed", 4))


@query("k1_top_candidates", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, round(Price, {R}) as Price, round(PredictedScore, {R}) as PredictedScore,
  Direction, cast(rank as int) as rank from a_top where rank <= 10""")
def q_k1(offers):
    """K1 + R5: 10 best (rounded) prices per auction by smoothed score."""
    sm = RP.pack_curve(RP.score_candidates(RP.pack_candidates(offers), _half()), (AUCTION,), 1, RP.CONTEXT)
    top, _ = RP.recommend(sm)
    return top.select(AUCTION, "Price", "PredictedScore", "Direction", "rank")


R5_SQL = f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, File, round(CustomerPrice, {R}) as CustomerPrice, round(WinnerPrice, {R}) as WinnerPrice,
  CustomerStatus, round(RecommendedPrice, {R}) as RecommendedPrice,
  round(PredictedScore, {R}) as PredictedScore, Direction from a_rec"""


@query("r5_recommend", R5_SQL)
def q_r5(offers):
    """R5 + K2: one recommended price per auction (first of K1)."""
    return RP.reprice(offers, prob=_half(), degree=1)


@query("r6_auction_scores", f"""
with {CONTEXT_SQL},{reprice_sql('a_', HALF)}
select CompetitionName, cast(sum(case when IsBuyBoxWinner=1 then 1 else 0 end) as bigint) as n_winners,
  round(coalesce(min(case when IsBuyBoxWinner=1 then Score end), 0), {R}) as WinnerScoreMin,
  round(coalesce(max(case when IsBuyBoxWinner=1 then Score end), 0), {R}) as WinnerScoreMax,
  round(max(case when IsCustomer=1 then Score end), {R}) as CustomerScore
from a_sc where not is_candidate group by 1""")
def q_r6(offers):
    """Winner / customer scores of the real offers."""
    sc = RP.score_candidates(RP.pack_candidates(offers), _half())
    return RP.auction_scores(sc).select(AUCTION, "n_winners", "WinnerScoreMin", "WinnerScoreMax",
                                        "CustomerScore")


# ------------------------------------------------------ back-test

_ONLY = "select File from events"
BACKTEST_SQL = f"""{EVENTS_SQL.strip()},
{CONTEXT_SQL},{reprice_sql('h_', HALF, _ONLY)},{reprice_sql('f_', FEAT, _ONLY)},
res as (select h.File, h.CustomerPrice as CurrentPrice, h.WinnerPrice, h.CustomerStatus,
          h.RecommendedPrice as Half, f.RecommendedPrice as Featured, e.NextId as NextFile, e.NextPrice
        from h_rec h join f_rec f on h.File = f.File left join events e on e.File = h.File),
gaps as (select File, NextFile, CustomerStatus, 'Half' as clf,
           {_r2('Half')} - {_r2('NextPrice')} as gap from res
         union all
         select File, NextFile, CustomerStatus, 'Featured' as clf,
           {_r2('Featured')} - {_r2('NextPrice')} as gap from res)"""


def _results(offers):
    return reprice_many(offers, _events(offers), {"Half": _half(), "Featured": _feat()}, degree=1)


@query("r7_reprice_many", f"""
with {BACKTEST_SQL}
select File, round(CurrentPrice, {R}) as CurrentPrice, round(WinnerPrice, {R}) as WinnerPrice,
  CustomerStatus, round(Half, {R}) as Half, round(Featured, {R}) as Featured, NextFile,
  round(NextPrice, {R}) as NextPrice from res""")
def q_r7(offers):
    """R7 + J5: all listed auctions repriced by two scorers, one column each."""
    return _results(offers)


@query("r8_backtest", f"""
with {BACKTEST_SQL}
select clf, count(gap) as count, round(avg(gap), {R}) as mean, round(stddev_samp(gap), {R}) as std,
  round(min(gap), {R}) as min, round(quantile_cont(gap, 0.25), {R}) as p25,
  round(quantile_cont(gap, 0.5), {R}) as p50, round(quantile_cont(gap, 0.75), {R}) as p75,
  round(max(gap), {R}) as max from gaps group by clf""")
def q_r8(offers):
    """R8 + A8: recommendation minus next winning price, described per scorer."""
    return backtest_summary(_results(offers), ["Half", "Featured"])


@query("r9_split_by_gap", f"""
with {BACKTEST_SQL}
select File, NextFile, CustomerStatus, clf, round(gap, {R}) as gap,
  case when gap > 0 then 'greater' else 'smaller' end as side
from gaps where CustomerStatus <> 1 and gap <> 0""")
def q_r9(offers):
    """Lost events whose recommendation over- / undershot the next price."""
    return RP.split_by_gap(RP.backtest(_results(offers), ["Half", "Featured"]))


@query("r10_compare_classifiers", f"""
with {BACKTEST_SQL},
w as (select File, NextFile, max(case when clf='Half' then gap end) as Half,
        max(case when clf='Featured' then gap end) as Featured from gaps group by 1, 2)
select File, NextFile, round(Half, {R}) as Half, round(Featured, {R}) as Featured,
  round(Half - Featured, {R}) as gap_diff from w""")
def q_r10(offers):
    """Two recommenders' gaps side by side."""
    return RP.compare_classifiers(RP.backtest(_results(offers), ["Half", "Featured"]),
                                  "Half", "Featured")


FORMULA = ("(0.2::double + 0.3::double*(1.0::double - ldn) + 0.2::double*ipn + 0.1::double*dpn"
           " + 0.1::double*IsFeaturedMerchant)")


class FormulaModel:
    """A fixed linear formula of the serving features, in a model's place."""

    def transform(self, df: DataFrame) -> DataFrame:
        p = (F.lit(0.2) + F.lit(0.3) * (F.lit(1.0) - F.col(LANDED)) + F.lit(0.2) * F.col("IdealPointCompetition")
             + F.lit(0.1) * F.col("DifftoMinLandedPriceProduct") + F.lit(0.1) * F.col("IsFeaturedMerchant"))
        return df.withColumn("prob", p).withColumn("prediction", (F.col("prob") > 0.5).cast("double"))


SERVED = [LANDED, "IdealPointCompetition", "DifftoMinLandedPriceProduct", "IsFeaturedMerchant", "IsFulfilledByAmazon"]


@query("r7_reprice_formula_model", f"""
with {EVENTS_SQL.strip()},{CONTEXT_SQL},{reprice_sql('m_', FORMULA, "select File from events")}
select r.File, round(r.CustomerPrice, {R}) as CurrentPrice, round(r.WinnerPrice, {R}) as WinnerPrice,
  r.CustomerStatus, round(r.RecommendedPrice, {R}) as Formula, e.NextId as NextFile,
  round(e.NextPrice, {R}) as NextPrice from m_rec r left join events e on e.File = r.File""")
def q_r7_formula(offers):
    """R7 through the model path (FP2 features of offers + candidates, M4, R3-R5)
    with a fixed formula of the features as the model."""
    trained = {"Formula": {"model": FormulaModel(), "features": SERVED, "clf": 0}}
    return reprice_models(offers, _events(offers), trained, W.derived_platform_dimension(offers), degree=1)


@query("r7_reprice_models")
def q_r7_models(offers):
    """R7 with two trained models: forest and logistic regression fit on the serving
    features of all auctions (rows-only check)."""
    from bidscope.operators.models import train
    dim = W.derived_platform_dimension(offers)
    minima = W.product_minima(landed_price(offers))
    frame = cut_lineage(FP.serve_features(offers, dim, minima, SERVED, len(SERVED)))      # read by both fits
    trained = {"RandomForest": train(frame, 1, SERVED, cut=True), "LogisticRegression": train(frame, 2, SERVED, cut=True)}
    return reprice_models(offers, _events(offers), trained, dim, minima, degree=1)


@query("u3_union_training", f"""
with au as (select CompetitionName, min(auction_time) as t from offers group by 1),
rk as (select CompetitionName, row_number() over (order by t, CompetitionName) - 1 as r, count(*) over () as n from au)
select case when r < round_even(0.3::double * n, 0) then 'new' else 'old' end as side, count(*) as n_rows,
  count(distinct o.CompetitionName) as n_auctions, sum(l_orderkey) as orders
from offers o join rk on o.CompetitionName = rk.CompetitionName group by 1""")
def q_u3(offers):
    """Old + new training data (the two sides of the W11 split) by name, counted by side."""
    train, test = W.auction_order_split(offers, 0.3, "auction_time")
    both = train.withColumn("side", F.lit("old")).unionByName(test.withColumn("side", F.lit("new")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(AUCTION).alias("n_auctions"),
                                    F.sum("l_orderkey").alias("orders"))


# ------------------------------------------------------ feature pipelines

def fp_input(offers: DataFrame, with_time: bool = False) -> DataFrame:
    """Stand-in offers in the offers-schema types (ids as text)."""
    cols = [F.col("IsBuyBoxWinner"), F.col("MarketplaceId"),
            F.col("ProductId").cast("string").alias("ProductId"),
            F.col("SellerId").cast("string").alias("SellerId"),
            F.col("IsFeaturedMerchant"), F.col("IsFulfilledByAmazon"), F.col("ListingPrice"),
            F.col("ShippingPrice"), F.col("ShippingTime_maxHours"),
            F.col("s_acctbal").alias("SellerFeedbackRating"),
            F.col("CompetitionName").cast("string").alias("CompetitionName")]
    if with_time:
        cols.append(F.col("auction_time").alias("Time"))
    return offers.select(*cols)


FP_IN_SQL = """
fi as (select IsBuyBoxWinner, MarketplaceId, cast(ProductId as varchar) as ProductId,
  cast(SellerId as varchar) as SellerId, IsFeaturedMerchant, IsFulfilledByAmazon, ListingPrice,
  ShippingPrice, ShippingTime_maxHours, s_acctbal as SellerFeedbackRating,
  cast(CompetitionName as varchar) as CompetitionName, auction_time from offers),
pdim as (select MarketplaceId, min(SellerId) as P from fi group by 1)"""


def _code(c: str) -> str:
    return (f"(case when {c} is null or {c} = '' then -1.0::double else ln(cast(array_to_string("
            f"list_transform(string_split({c}, ''), lambda x: cast(ascii(x) as varchar)), '') "
            f"as double)) end)")


def _mmw(c: str, w: str) -> str:
    return (f"(case when max({c}) over {w} = min({c}) over {w} then 1.0::double else "
            f"({c} - min({c}) over {w})/(max({c}) over {w} - min({c}) over {w}) end)")


def fp_sql(src: str, minima: str | None, p: str = "") -> str:
    """FP add_features over CTE ``src`` (optionally with a minima CTE); ``p`` prefixes its CTEs."""
    a1, a2, a3, a4 = (f"{p}a{i}" for i in (1, 2, 3, 4))
    dp0 = (f"LandedPrice - coalesce(mn.m, min(LandedPrice) over (partition by {a2}.ProductId))"
           if minima else "LandedPrice - min(LandedPrice) over (partition by ProductId)")
    join = f"{a2} left join {minima} mn on {a2}.ProductId = mn.ProductId" if minima else a2
    return f"""
{a1} as (select s.*, pdim.P, ListingPrice+ShippingPrice as LandedPrice,
   case when ShippingTime_maxHours=0 then 1 else ShippingTime_maxHours end as H
  from {src} s join pdim on s.MarketplaceId = pdim.MarketplaceId),
{a2} as (select *, LandedPrice - min(LandedPrice) over w as D1,
   case when min(case when SellerId = P then LandedPrice end) over w is null then -9999.0::double
        else LandedPrice - min(case when SellerId = P then LandedPrice end) over w end as D3,
   case when SellerId = P then 0 when max(case when SellerId = P then 1 else 0 end) over w = 1
        then 1 else -1 end as C2,
   min(LandedPrice) over w * min(H) over w - LandedPrice*H as IP
  from {a1} window w as (partition by CompetitionName)),
{a3} as (select {a2}.*, {dp0} as DP0 from {join}),
{a4} as (select *, {_mmw('DP0', 'wp')} as DP, {_mmw('LandedPrice', 'w')} as LDn,
    {_mmw('IP', 'w')} as IPn
  from {a3} window w as (partition by CompetitionName), wp as (partition by ProductId))"""


_FP1_NORM = {"SellerId": _code("SellerId"), "IsFeaturedMerchant": "IsFeaturedMerchant",
             "IsFulfilledByAmazon": "IsFulfilledByAmazon", "ShippingTime_maxHours": "H",
             "SellerFeedbackRating": "SellerFeedbackRating", "LandedPrice": "LDn",
             "DifftoMinLandedPriceCompetition": "D1", "DifftoAmzLandedPriceCompetition": "D3",
             "CompeteAmzCompetition": "C2", "IdealPointCompetition": "IPn"}


def _fp1_select(src: str, extra: str = "") -> str:
    pre = ", ".join(f"{v} as {k}" for k, v in _FP1_NORM.items())
    norm = ", ".join(f"round({_mmw(k, 'w')}, {R}) as {k}" for k in _FP1_NORM)
    return f"""
select IsBuyBoxWinner, round({_code('ProductId')}, {R}) as ProductId, round({_code('CompetitionName')}, {R})
  as CompetitionName, round(DP, {R}) as DifftoMinLandedPriceProduct, {norm}{extra}
from (select IsBuyBoxWinner, ProductId, CompetitionName, DP, {pre} from {src})
window w as (partition by CompetitionName)"""


@query("fp1_train_features", f"""
with {FP_IN_SQL.strip()},{fp_sql('fi', None)}{_fp1_select('a4')}""")
def q_fp1(offers):
    """FP1: training features (W1-W6, P9-P12, W12) on the stand-in offers."""
    df = fp_input(offers)
    return FP.train_features(df, W.derived_platform_dimension(df))


@query("fp2_serve_features", f"""
with {FP_IN_SQL.strip()},{fp_sql('fi', None)}
select IsBuyBoxWinner, round(IPn, {R}) as IdealPointCompetition, round(LDn, {R}) as LandedPrice,
  IsFulfilledByAmazon, round(DP, {R}) as DifftoMinLandedPriceProduct, CompetitionName from a4""")
def q_fp2(offers):
    """FP2: serving features, top-4 of a ranked list, no W12."""
    df = fp_input(offers)
    ranked = ["IdealPointCompetition", "LandedPrice", "IsFulfilledByAmazon",
              "DifftoMinLandedPriceProduct", "SellerId"]
    return FP.serve_features(df, W.derived_platform_dimension(df), None, ranked, 4,
                             keep=["CompetitionName"])


@query("fp3_train_test_features", f"""
with {FP_IN_SQL.strip()},
au as (select CompetitionName, min(auction_time) as t from fi group by 1),
rk as (select CompetitionName, row_number() over (order by t, CompetitionName) - 1 as r,
       count(*) over () as n from au),
te as (select fi.* from fi join rk on fi.CompetitionName = rk.CompetitionName
       where r < round_even(0.3::double * n, 0)),
tr as (select fi.* from fi join rk on fi.CompetitionName = rk.CompetitionName
       where r >= round_even(0.3::double * n, 0)),
trmin as (select ProductId, min(ListingPrice+ShippingPrice) as m from tr group by 1),
{fp_sql('te', 'trmin', 't')},{fp_sql('tr', None, 'r')}{_fp1_select('ta4', ", 'test' as side")}
union all by name {_fp1_select('ra4', ", 'train' as side")}""")
def q_fp3(offers):
    """FP3: W11 split; test features use product minima learned on train; both sides."""
    df = fp_input(offers, with_time=True)
    both = FP.train_test_frame(df, W.derived_platform_dimension(df), 0.3, "Time")
    return both.withColumn("side", F.when(F.col(FP.IS_TEST), "test").otherwise("train")).drop(FP.IS_TEST)
