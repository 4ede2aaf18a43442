"""Queries for row-level functions (P*) and price-grid functions (G*, U4, J7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.functions import grid as G
from bidscope.functions import scalars as P
from bidscope.operators.features import derived_platform_dimension, platform_seller
from bidscope.operators.groups import with_group_stats
from bidscope.operators.reprice import auction_context, winner_price
from bidscope.plans.auction_view import load
from bidscope.plans.catalog import (CONTEXT_SQL, KEY, KEY_SQL, LANDED_SQL, query, sql_grid,
                                    sql_linspace, sql_logspace)
from bidscope.schema import AUCTION, LANDED

R = 6


def _lp(offers):
    return P.landed_price(offers)


# ---------------------------------------------------------------- P: scalars

@query("p3_default_missing", f"""
select {KEY_SQL}, round(coalesce(nullif(ShippingPrice, 0), -1), {R}) as ShippingPrice,
       coalesce(case when IsFeaturedMerchant=1 then 'new' end, '') as SubCondition
from offers""")
def q_p3(offers):
    """Absent prices -> -1, absent text -> "" (absent: zero tax, non-featured)."""
    src = offers.select(*KEY, F.nullif(F.col("ShippingPrice"), F.lit(0.0)).alias("ShippingPrice"),
                        F.when(F.col("IsFeaturedMerchant") == 1, F.lit("new")).alias("SubCondition"))
    return P.default_missing(src, columns=["ShippingPrice", "SubCondition"])


@query("p1_flag", f"""
select {KEY_SQL}, case l_linenumber % 3 when 0 then 1 when 1 then 0 end as flag,
  case l_linenumber % 3 when 0 then 1 when 1 then -1 end as winner from offers""")
def q_p1(offers):
    """Text flags: "true" -> 1, other text -> 0 (or -1), absent -> null."""
    n = F.col("l_linenumber") % 3
    text = F.when(n == 0, "true").when(n == 1, "false")
    return offers.select(*KEY, P.flag(text).alias("flag"), P.flag(text, 1, -1).alias("winner"))


@query("p2_present_flag", f"""
select {KEY_SQL}, case when IsFeaturedMerchant = 1 then 1 else 0 end as ConditionNotes from offers""")
def q_p2(offers):
    """1 where the tag is there, even if empty."""
    return offers.select(*KEY, P.present_flag(F.when(F.col("IsFeaturedMerchant") == 1, F.lit(""))).alias("ConditionNotes"))


@query("p4_is_customer", f"""
select {KEY_SQL}, case when SellerId = min(SellerId) over (partition by CompetitionName) then 1 else 0 end as mine
from offers""")
def q_p4(offers):
    """The offer's seller is the notification's seller (here: the auction's least id)."""
    head = with_group_stats(offers, AUCTION, {"head": F.min("SellerId")})
    return head.select(*KEY, P.is_customer("SellerId", "head").alias("mine"))


@query("p23_columns_of_type", """
select column_name as name from (describe select * from offers) where column_type = 'VARCHAR'""")
def q_p23(offers):
    """Names of the text columns of the offers."""
    names = P.columns_of_type(offers)
    return offers.agg(F.array(*[F.lit(n) for n in names]).alias("names")).select(F.explode("names").alias("name"))


@query("p5_file_stem", """
select distinct MarketplaceId, CompetitionName,
  regexp_replace(regexp_extract('/data/' || MarketplaceId || '/' || CompetitionName || '.xml',
                 '([^/]*)$', 1), '\\.[^.]*$', '') as stem
from offers""")
def q_p5(offers):
    """P5: file stem of each auction's notification path."""
    path = F.concat(F.lit("/data/"), F.col("MarketplaceId"), F.lit("/"),
                    F.col(AUCTION).cast("string"), F.lit(".xml"))
    return offers.select("MarketplaceId", AUCTION, P.file_stem(path).alias("stem")).distinct()


@query("p6_seconds_since_2016", f"""
select distinct strftime(l_shipdate, '%Y-%m-%d') as day,
  round((epoch_ms(l_shipdate) - epoch_ms(timestamp '2016-01-01'))/1000.0::double, {R}) as Time
from offers""")
def q_p6(offers):
    """ISO notification time text -> seconds since 2016-01-01."""
    iso = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return offers.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
                         P.seconds_since_2016(iso).alias("Time")).distinct()


@query("p7_log_time", f"""
select distinct strftime(l_shipdate, '%Y-%m-%d') as day,
  round(ln(epoch_ms(l_shipdate)/1000.0::double), {R}) as LogTime
from offers""")
def q_p7(offers):
    """Natural log of a (positive) time value: epoch seconds."""
    secs = F.unix_micros(F.to_utc_timestamp(F.col("l_shipdate").cast("timestamp"), "UTC")) / 1e6
    return offers.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
                         P.log_time(secs).alias("LogTime")).distinct()


@query("p8_landed_price", f"""
select {KEY_SQL}, round(ListingPrice+ShippingPrice, {R}) as LandedPrice from offers""")
def q_p8(offers):
    """LandedPrice = ListingPrice + ShippingPrice."""
    return _lp(offers).select(*KEY, LANDED)


@query("p9_ship_hours_floor", f"""
select {KEY_SQL}, case when ShippingTime_maxHours=0 then 1 else ShippingTime_maxHours end
  as ShippingTime_maxHours from offers""")
def q_p9(offers):
    """Max shipping hours 0 -> 1."""
    return offers.select(*KEY, P.ship_hours_floor("ShippingTime_maxHours").alias("ShippingTime_maxHours"))


@query("p10_text_code", f"""
select p_partkey, round(case when p_type is null or p_type = '' then -1 else
  ln(cast(array_to_string(list_transform(string_split(p_type, ''),
     lambda x: cast(ascii(x) as varchar)), '') as double)) end, {R}) as type_code
from part""", view=False)
def q_p10(spark, sf_dir):
    """P10: text code of the part type strings."""
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", P.text_code("p_type").alias("type_code"))


@query("p11_platform_seller", """
select MarketplaceId, min(SellerId) as PlatformSellerId from offers group by MarketplaceId""")
def q_p11(offers):
    """Platform seller of each market (dimension join)."""
    dim = derived_platform_dimension(offers)
    return platform_seller(offers.select("MarketplaceId").distinct(), dim)


@query("p12_drop_if_present", f"""
select {KEY_SQL}, IsBuyBoxWinner, IsFulfilledByAmazon, IsFeaturedMerchant,
  round(ListingPrice, {R}) as ListingPrice, round(ShippingPrice, {R}) as ShippingPrice,
  ShippingTime_maxHours, round(s_acctbal, {R}) as s_acctbal, IsCustomer from offers""")
def q_p12(offers):
    """Drop currency / market / domestic-shipping columns when present."""
    df = offers.drop("l_shipdate", "auction_time")
    return P.drop_if_present(df, ["ListingCurrency", "ShippingCurrency", "MarketplaceId",
                                  "ShipsDomestically"])


@query("p13_cut_features", f"""
select IsBuyBoxWinner, round(ListingPrice, {R}) as ListingPrice, ShippingTime_maxHours,
  {KEY_SQL} from offers""")
def q_p13(offers):
    """Label + the first 2 features of a ranked list."""
    ranked = ["ListingPrice", "ShippingTime_maxHours", "IsFeaturedMerchant", "ShippingPrice"]
    return P.cut_features(offers, ranked, 2, keep=KEY)


@query("p14_round2", f"""
select {KEY_SQL}, round(round_even((ListingPrice+ShippingPrice)*100.0::double, 0)/100.0::double, {R})
  as LandedRounded from offers""")
def q_p14(offers):
    """Half-even rounding to cents."""
    return _lp(offers).select(*KEY, P.round2(LANDED).alias("LandedRounded"))


@query("p15_clip", f"""
select {KEY_SQL}, round(least(greatest(ListingPrice+ShippingPrice, 1000.0::double),
  1500.0::double), {R}) as Clipped from offers""")
def q_p15(offers):
    """Clamp landed prices into [1000, 1500]."""
    return _lp(offers).select(*KEY, P.clip(LANDED, 1000.0, 1500.0).alias("Clipped"))


@query("p16_normal_weight", f"""
with {LANDED_SQL},
m as (select *, min(LandedPrice) over (partition by CompetitionName) as mu from lp)
select {KEY_SQL}, round(exp(-((LandedPrice-mu)*(LandedPrice-mu))/2.0::double)
  / sqrt(2.0::double*pi()), {R}) as Weight from m""")
def q_p16(offers):
    """N(mu, 1) density at LandedPrice, mu = auction minimum."""
    from bidscope.operators.groups import with_group_stats
    df = with_group_stats(_lp(offers), AUCTION, {"mu": F.min(LANDED)})
    return df.select(*KEY, P.normal_weight(LANDED, "mu").alias("Weight"))


@query("p17_price_direction", f"""
with {LANDED_SQL},
m as (select *, max(case when IsCustomer=1 then LandedPrice end)
        over (partition by CompetitionName) as cp from lp)
select {KEY_SQL}, case when round_even(LandedPrice*1000.0::double,0)/1000.0::double
                             > round_even(cp*1000.0::double,0)/1000.0::double then 'UP'
  when round_even(LandedPrice*1000.0::double,0)/1000.0::double
       < round_even(cp*1000.0::double,0)/1000.0::double then 'DOWN' else 'KEEP' end as Direction
from m""")
def q_p17(offers):
    """Each offer's price vs the auction customer's price (3 decimals)."""
    from bidscope.operators.groups import with_group_stats
    df = with_group_stats(_lp(offers), AUCTION,
                          {"cp": F.max(F.when(F.col("IsCustomer") == 1, F.col(LANDED)))})
    return df.select(*KEY, P.price_direction(LANDED, "cp").alias("Direction"))


@query("p18_status_name", f"""
select {KEY_SQL}, case when IsBuyBoxWinner=1 then 'Win' else 'Lose' end as Status from offers""")
def q_p18(offers):
    """1 -> Win, else Lose."""
    return offers.select(*KEY, P.status_name("IsBuyBoxWinner").alias("Status"))


@query("p19_relabel", f"""
select {KEY_SQL}, case when IsBuyBoxWinner=1 then 1.0::double else 0.0::double end as label01,
  case when (case when IsBuyBoxWinner=1 then 1.0 else 0.0 end)=1 then 1 else -1 end as labelpm
from offers""")
def q_p19(offers):
    """+1/-1 -> 1/0 for Spark ML and back."""
    df = offers.select(*KEY, P.to_01("IsBuyBoxWinner").alias("label01"))
    return df.withColumn("labelpm", P.to_pm1("label01"))


@query("p20_round_prediction", f"""
select {KEY_SQL}, round_even(ListingPrice/1000.0::double, 0) as Rounded from offers""")
def q_p20(offers):
    """P20: half-even rounding of a predicted value."""
    return offers.select(*KEY, P.round_prediction(F.col("ListingPrice") / 1000.0).alias("Rounded"))


@query("p21_classifier_name", """
select distinct l_linenumber,
  case l_linenumber when 1 then 'RandomForest' when 2 then 'LogisticRegression'
   when 3 then 'KNeighbors' when 4 then 'SVM' when 5 then 'AdaBoost' when 6 then 'XGBoost'
   else 'Wrong' end as Classifier
from offers""")
def q_p21(offers):
    """Classifier id -> name (line number as the id)."""
    return offers.select("l_linenumber", P.classifier_name("l_linenumber").alias("Classifier")).distinct()


# ------------------------------------------------------------ G: price grid

def _context(offers):
    ctx = auction_context(offers)
    return ctx.select(AUCTION, "n_winners", "MinPrice", "MaxPrice", "WinnerPrice",
                      "CustomerPrice", "CustomerStatus", "lo", "hi", "mid").dropDuplicates([AUCTION])


@query("g1_linspace", f"""
with {CONTEXT_SQL},
e as (select CompetitionName, unnest({sql_linspace('MinPrice', 'MaxPrice', 5)}) as v,
        unnest(range(0,5)) as pos from ctx)
select CompetitionName, cast(pos as int) as pos, round(v, {R}) as value from e""")
def q_g1(offers):
    """G1: 5 evenly spaced prices from the auction minimum to maximum."""
    return _context(offers).select(AUCTION, F.posexplode(G.linspace(F.col("MinPrice"),
                                                                      F.col("MaxPrice"), 5))
                                   ).withColumnRenamed("col", "value")


@query("g2_logspace", f"""
with {CONTEXT_SQL},
e as (select CompetitionName, unnest({sql_logspace('MinPrice', 'MaxPrice', 5)}) as v,
        unnest(range(0,5)) as pos from ctx)
select CompetitionName, cast(pos as int) as pos, round(v, {R}) as value from e""")
def q_g2(offers):
    """5 log-spaced prices from the auction minimum to maximum."""
    return _context(offers).select(AUCTION, F.posexplode(G.logspace(F.col("MinPrice"),
                                                                      F.col("MaxPrice"), 5))
                                   ).withColumnRenamed("col", "value")


@query("g3_winner_price", f"""
with {LANDED_SQL},
a as (select CompetitionName, cast(sum(case when IsBuyBoxWinner=1 then 1 else 0 end) as bigint) as n_winners,
   min(LandedPrice) as MinPrice,
   coalesce(min(case when IsBuyBoxWinner=1 then LandedPrice end), min(LandedPrice)) as WinnerPrice
  from lp group by CompetitionName),
h as (select a.CompetitionName, min(lp.ShippingTime_maxHours) as WinnerHours
  from a join lp on a.CompetitionName = lp.CompetitionName and lp.LandedPrice = a.WinnerPrice
  group by a.CompetitionName)
select a.CompetitionName, n_winners, round(WinnerPrice, {R}) as WinnerPrice,
  n_winners = 0 as NoWinner, WinnerHours, round(MinPrice, {R}) as MinPrice
from a left join h on a.CompetitionName = h.CompetitionName""")
def q_g3(offers):
    """Winner price per auction (min over winners, auction min if none)."""
    return winner_price(offers)


@query("g4_price_bounds", f"""
with {CONTEXT_SQL}
select CompetitionName, round(lo, {R}) as lo, round(hi, {R}) as hi, round(mid, {R}) as mid from bnd""")
def q_g4(offers):
    """Search range (lo, hi, mid) from customer status / price and winner price."""
    return _context(offers).select(AUCTION, "lo", "hi", "mid")


@query("g5_price_grid", f"""
with {CONTEXT_SQL},
g as (select CompetitionName, {sql_grid('lo', 'mid', 'hi')} as grid from bnd)
select CompetitionName, cast(len(grid) as int) as n_points, round(list_sum(grid), {R}) as total,
  round(list_min(grid), {R}) as first_price, round(list_max(grid), {R}) as last_price from g""")
def q_g5(offers):
    """G5 + U4: candidate price grid per auction (size, sum, ends)."""
    c = G.with_price_grid(_context(offers))
    return c.select(AUCTION, F.size("grid").alias("n_points"),
                    F.aggregate("grid", F.lit(0.0), lambda a, x: a + x).alias("total"),
                    F.array_min("grid").alias("first_price"), F.array_max("grid").alias("last_price"))


@query("j7_candidate_expansion", f"""
with {CONTEXT_SQL},
g as (select CompetitionName, {sql_grid('lo', 'mid', 'hi')} as grid from bnd)
select CompetitionName, round(unnest(grid), {R}) as Price from g""")
def q_j7(offers):
    """Lateral expansion of each auction's own grid into candidate rows."""
    c = G.with_price_grid(_context(offers))
    return G.exploded(c, "grid", [AUCTION], "pos", "Price").drop("pos")


@query("g6_split_range", f"""
with {CONTEXT_SQL},
s as (select CompetitionName, case
   when CustomerStatus = -1 then (case when MinPrice < CustomerPrice
        then {sql_linspace('MinPrice', 'CustomerPrice', 5)} else {sql_linspace('CustomerPrice', 'MinPrice', 5)} end)
   when CustomerStatus = 1 then (case when MaxPrice > CustomerPrice
        then {sql_linspace('CustomerPrice', 'MaxPrice', 5)} else {sql_linspace('MaxPrice', 'CustomerPrice', 5)} end)
   end as r from ctx),
e as (select CompetitionName, unnest(r) as v, unnest(range(0,5)) as pos from s)
select CompetitionName, cast(pos as int) as pos, round(v, {R}) as value from e""")
def q_g6(offers):
    """5-point split between the auction min/max and the customer price by status."""
    c = _context(offers)
    arr = G.split_range(F.col("MinPrice"), F.col("MaxPrice"), F.col("CustomerPrice"), 5,
                        F.col("CustomerStatus"))
    return c.select(AUCTION, F.posexplode(arr)).withColumnRenamed("col", "value")


def _limit_sql() -> str:
    g = "grid"
    n = f"len({g})"
    mn, mx = f"list_min({g})", f"list_max({g})"
    med = (f"((list_sort({g})[cast(floor(({n}-1)/2) as bigint)+1] + "
           f"list_sort({g})[cast(floor({n}/2) as bigint)+1])/2.0::double)")

    def clip(lo, hi):
        return f"list_transform(list_sort({g}), lambda x: least(greatest(x, {lo}), {hi}))"

    def lin(a, b):
        return (f"list_transform(range(0, {n}), lambda i: case when {n} = 1 then ({a}) "
                f"when i = {n}-1 then ({b}) else i*((({b})-({a}))/({n}-1)) + ({a}) end)")
    lose = (f"case when {mn} < CustomerPrice then {clip(mn, 'CustomerPrice')} "
            f"when {mn} = CustomerPrice then {clip('CustomerPrice', med)} "
            f"else (case when CustomerPrice < CustomerPrice then {lin('CustomerPrice', 'CustomerPrice')} "
            f"else {lin('CustomerPrice', 'CustomerPrice')} end) end")
    win = (f"case when {mx} > CustomerPrice then {clip('CustomerPrice', mx)} "
           f"when {mx} = CustomerPrice then {clip(med, 'CustomerPrice')} "
           f"else {lin('CustomerPrice', 'CustomerPrice')} end")
    return f"(case when CustomerStatus = -1 then {lose} when CustomerStatus = 1 then {win} else list_sort({g}) end)"


@query("g7_limit_prices", f"""
with {CONTEXT_SQL},
g as (select CompetitionName, CustomerPrice, CustomerStatus, {sql_grid('lo', 'mid', 'hi')} as grid from bnd),
l as (select CompetitionName, {_limit_sql()} as lim from g),
e as (select CompetitionName, unnest(lim) as v, unnest(range(0, len(lim))) as pos from l)
select CompetitionName, cast(pos as int) as pos, round(v, {R}) as value from e""")
def q_g7(offers):
    """Grid clipped around the customer price by win/lose status."""
    c = G.with_price_grid(_context(offers))
    c = G.with_limited_prices(c, "grid", "CustomerPrice", "CustomerStatus")
    return G.exploded(c, "limited", [AUCTION])


@query("g8_nearest", f"""
with {CONTEXT_SQL},
g as (select CompetitionName, WinnerPrice, {sql_grid('lo', 'mid', 'hi')} as grid from bnd),
e as (select CompetitionName, WinnerPrice, unnest(grid) as x, unnest(range(0, len(grid))) as i from g),
r as (select CompetitionName, x, row_number() over (partition by CompetitionName
        order by abs(x - WinnerPrice), i) as rn from e)
select CompetitionName, round(x, {R}) as Nearest from r where rn = 1""")
def q_g8(offers):
    """Grid price nearest to the winner price (first on ties)."""
    c = G.with_price_grid(_context(offers))
    return c.select(AUCTION, G.nearest(F.col("grid"), F.col("WinnerPrice")).alias("Nearest"))
