"""Core queries: the view itself and the minimum slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidscope.plans.catalog import query
from bidscope.plans.minimum_slice import minimum_slice, minimum_slice_scores

R = 6  # rounding digits in the oracle SQL

# Common oracle CTE for the minimum slice.
SLICE_SQL = """
one as (select CompetitionName from offers group by CompetitionName
        having sum(case when IsBuyBoxWinner=1 then 1 else 0 end)=1),
s1 as (select o.*, ListingPrice+ShippingPrice as LandedPrice,
        case when ShippingTime_maxHours=0 then 1 else ShippingTime_maxHours end as hrs
       from offers o where CompetitionName in (select CompetitionName from one)),
s2 as (select *, min(LandedPrice) over (partition by CompetitionName)
                 * min(hrs) over (partition by CompetitionName) - LandedPrice*hrs as ip from s1),
s3 as (select *, case when max(ip) over w = min(ip) over w then 1.0
              else (ip - min(ip) over w)/(max(ip) over w - min(ip) over w) end as ipn
       from s2 window w as (partition by CompetitionName)),
s4 as (select *, IsFulfilledByAmazon*0.5 + 0.5*ipn + 0.5*IsFeaturedMerchant as NewScore from s3),
s5 as (select *, case when NewScore = max(NewScore) over (partition by CompetitionName)
              then 1 else -1 end as NewDecision from s4)
"""


@query("auction_view", f"""
select MarketplaceId, ProductId, SellerId, CompetitionName, l_orderkey, l_linenumber,
       IsBuyBoxWinner, IsFulfilledByAmazon, IsFeaturedMerchant,
       round(ListingPrice,{R}) as ListingPrice, round(ShippingPrice,{R}) as ShippingPrice,
       ShippingTime_maxHours, round(s_acctbal,{R}) as s_acctbal, IsCustomer,
       cast(auction_time as varchar) as auction_time
from offers""")
def q_auction_view(offers):
    """Step 0: the auction view (offers in the offer schema)."""
    return offers.drop("l_shipdate").withColumn(
        "auction_time", F.date_format("auction_time", "yyyy-MM-dd HH:mm:ss"))


@query("minimum_slice_confusion", f"""
with {SLICE_SQL.strip()},
lab as (select * from (values (-1),(1)) t(x))
select a.x as actual, p.x as predicted,
       cast(coalesce((select count(*) from s5 where IsBuyBoxWinner=a.x and NewDecision=p.x),0) as bigint) as n
from lab a, lab p""")
def q_minimum_slice(offers):
    """A5 over the minimum slice: F5, P8, P9, W1, W4, W6, M5(prob .5), W8."""
    return minimum_slice(offers)


@query("minimum_slice_class_scores", f"""
with {SLICE_SQL.strip()},
c as (select x as label,
        sum(case when IsBuyBoxWinner=x and NewDecision=x then 1 else 0 end)::double as tp,
        sum(case when NewDecision=x then 1 else 0 end)::double as pp,
        sum(case when IsBuyBoxWinner=x then 1 else 0 end)::double as ap
      from s5, (values (-1),(1)) t(x) group by x),
m as (select label, case when pp>0 then tp/pp else 0 end as pr,
             case when ap>0 then tp/ap else 0 end as rc, ap from c)
select label, round(pr,{R}) as precision, round(rc,{R}) as recall,
       round(case when pr+rc>0 then 2*pr*rc/(pr+rc) else 0 end,{R}) as f1,
       cast(ap as bigint) as support from m""")
def q_minimum_slice_scores(offers):
    """A6 over the minimum slice."""
    return minimum_slice_scores(offers)
