"""Auction view over the driver's TPC-H-like tables.

The test tables carry no auctions, so lineitem plays the offers: brand is
the market, part the product, part x ship year the auction, supplier the
seller.  This builds input rows in the offers schema only; every
operator of the library then runs on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.operators.groups import with_group_stats
from bidscope.schema import AUCTION, CUSTOMER

VIEW_COLUMNS = [
    "MarketplaceId", "ProductId", "SellerId", "CompetitionName",
    "l_orderkey", "l_linenumber", "l_shipdate",
    "IsBuyBoxWinner", "IsFulfilledByAmazon", "IsFeaturedMerchant",
    "ListingPrice", "ShippingPrice", "ShippingTime_maxHours", "s_acctbal",
    "IsCustomer", "auction_time",
]

# Same view as DuckDB SQL (for the oracle side of every query).
VIEW_SQL = """
k as (
 select p.p_brand as MarketplaceId, l.l_partkey as ProductId, l.l_suppkey as SellerId,
  l.l_partkey*10000+year(l.l_shipdate) as CompetitionName,
  l.l_orderkey, l.l_linenumber, l.l_shipdate,
  case when l.l_returnflag='R' then 1 else -1 end as IsBuyBoxWinner,
  case when l.l_linestatus='F' then 1 else 0 end as IsFulfilledByAmazon,
  case when l.l_quantity>=25 then 1 else 0 end as IsFeaturedMerchant,
  p.p_retailprice*(1-l.l_discount) as ListingPrice,
  p.p_retailprice*l.l_tax as ShippingPrice,
  (l.l_linenumber-1)*24 as ShippingTime_maxHours,
  s.s_acctbal
 from lineitem l join part p on l.l_partkey=p.p_partkey join supplier s on l.l_suppkey=s.s_suppkey),
offers as (
 select *, case when row_number() over (partition by CompetitionName
   order by l_orderkey,l_linenumber,SellerId,l_shipdate)=1 then 1 else 0 end as IsCustomer,
 min(l_shipdate) over (partition by CompetitionName) as auction_time from k)
"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes that the files of a dimension may take, by Spark's estimate of the columns read, to be sent to all tasks.
SMALL = 4 << 20


def small(df: DataFrame) -> DataFrame:
    """A dimension marked for broadcast while Spark's estimate of it is below ``SMALL``; else its join is Spark's choice.

    The threshold of the session may be far lower, and then every offer row would be exchanged once more.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= SMALL else df


def auction_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer rows of the auction view (one row per lineitem)."""
    # flags first: the rows that are exchanged to the parts are narrow
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_shipdate",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(-1).alias("IsBuyBoxWinner"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("IsFulfilledByAmazon"),
        F.when(F.col("l_quantity") >= 25, 1).otherwise(0).alias("IsFeaturedMerchant"))
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    supp = small(load(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"))
    # Spark measures both sides of the parts' join and broadcasts them only while they are under its threshold.
    k = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey)
           .select(
               F.col("p_brand").alias("MarketplaceId"),
               F.col("l_partkey").alias("ProductId"),
               F.col("l_suppkey").alias("SellerId"),
               (F.col("l_partkey") * 10000 + F.year("l_shipdate")).alias(AUCTION),
               "l_orderkey", "l_linenumber", "l_shipdate",
               "IsBuyBoxWinner", "IsFulfilledByAmazon", "IsFeaturedMerchant",
               (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("ListingPrice"),
               (F.col("p_retailprice") * F.col("l_tax")).alias("ShippingPrice"),
               ((F.col("l_linenumber") - 1) * 24).alias("ShippingTime_maxHours"),
               "s_acctbal"))
    # The customer is the first offer of the auction in row-key order;
    # the row key is unique, so the minimum struct names exactly one row.
    first = F.struct("l_orderkey", "l_linenumber", "SellerId", "l_shipdate")
    k = k.withColumn("_rk", first)
    k = with_group_stats(k, AUCTION, {"_first": F.min("_rk"),
                                      "auction_time": F.min("l_shipdate")})
    return (k.withColumn(CUSTOMER, (F.col("_rk") == F.col("_first")).cast("int"))
             .select(*VIEW_COLUMNS))
