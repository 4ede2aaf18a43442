"""Data model: offer rows, column names and fixed dimension values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names of the flat offers table.
WINNER = "IsBuyBoxWinner"
MARKET = "MarketplaceId"
PRODUCT = "ProductId"
SELLER = "SellerId"
AUCTION = "CompetitionName"
CUSTOMER = "IsCustomer"
LISTING = "ListingPrice"
SHIPPING = "ShippingPrice"
LANDED = "LandedPrice"
MAX_HOURS = "ShippingTime_maxHours"
MIN_HOURS = "ShippingTime_minHours"
FBA = "IsFulfilledByAmazon"
FEATURED = "IsFeaturedMerchant"
TIME = "Time"

# Engineered columns.
DIFF_MIN_AUCTION = "DifftoMinLandedPriceCompetition"
DIFF_PLATFORM = "DifftoAmzLandedPriceCompetition"
COMPETES_PLATFORM = "CompeteAmzCompetition"
IDEAL_POINT = "IdealPointCompetition"
DIFF_MIN_PRODUCT = "DifftoMinLandedPriceProduct"

# Identifier columns protected from column-level cleaning.
ID_COLUMNS = (MARKET, SELLER, PRODUCT, AUCTION)

OFFER_SCHEMA = T.StructType([
    T.StructField(WINNER, T.IntegerType()),
    T.StructField(MARKET, T.StringType()),
    T.StructField(PRODUCT, T.StringType()),
    T.StructField(SELLER, T.StringType()),
    T.StructField("ConditionNotes", T.IntegerType()),
    T.StructField(FEATURED, T.IntegerType()),
    T.StructField(FBA, T.IntegerType()),
    T.StructField(LISTING, T.DoubleType()),
    T.StructField(SHIPPING, T.DoubleType()),
    T.StructField(MAX_HOURS, T.IntegerType()),
    T.StructField(MIN_HOURS, T.IntegerType()),
    T.StructField("ShippingTime_availtype", T.StringType()),
    T.StructField("ShipsDomestically", T.IntegerType()),
    T.StructField("ShipsFromCountry", T.StringType()),
    T.StructField("ShipsFromState", T.StringType()),
    T.StructField("SellerFeedbackRating", T.IntegerType()),
    T.StructField("SellerFeedbackCount", T.IntegerType()),
    T.StructField("SubCondition", T.StringType()),
    T.StructField(CUSTOMER, T.IntegerType()),
    T.StructField(TIME, T.DoubleType()),
    T.StructField(AUCTION, T.StringType()),
])

# Marketplace id -> the platform's own seller id in that
# market (country in the comment).  Markets not listed have no platform
# seller ("nothing").
PLATFORM_SELLERS = [
    ("A13V1IB3VIYZZH", "A1X6FK5RDHNB96"),  # FR
    ("A1F83G8C2ARO7P", "A3P5ROKL5A1OLE"),  # UK
    ("A1PA6795UKMFR9", "A3JWKAKR8XB7XF"),  # DE
    ("A1RKKUPIHCS9HS", "A1AT7YVPFBWXBL"),  # ES
    ("A21TJRUUN4KGV", "A380B3WNC3LCZM"),  # IN
    ("APJ6JRA9NG5V4", "A11IL2PNWYJU7H"),  # IT
    ("ATVPDKIKX0DER", "ATVPDKIKX0DER"),  # US
    ("A1VC38T7YXB528", "AN1VRQENFRJN5"),  # JP
    ("A2EUQ1WTGCTBG2", "A3DWYIK6Y9EEQB"),  # CA
]
NO_PLATFORM = "nothing"

# Classifier id -> name; 7 means "all six".
CLASSIFIER_NAMES = {
    1: "RandomForest",
    2: "LogisticRegression",
    3: "KNeighbors",
    4: "SVM",
    5: "AdaBoost",
    6: "XGBoost",
}
ALL_CLASSIFIERS = 7


def platform_dimension(spark: SparkSession) -> DataFrame:
    """The nine-row (MarketplaceId, PlatformSellerId) dimension."""
    return spark.createDataFrame(
        PLATFORM_SELLERS, schema="MarketplaceId string, PlatformSellerId string")
