"""Notification XML -> offers.

One file is one auction.  Files are read whole (``wholetext``: one row
per file, recursive listing, ``*.xml`` only).  Sections may sit anywhere
in the document, so each section is cut out by element name and parsed
with ``from_xml`` against a fixed schema; offers are exploded into rows
with the header values repeated.  A file whose document does not parse,
that has no header section, or whose offers lack a required tag, goes to
the quarantine table as a whole (quirks Q1, Q2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.scalars import file_stem, flag, is_customer, seconds_since_2016
from bidscope.session import cut_lineage

HEADER_SCHEMA = "SellerId string"
TRIGGER_SCHEMA = "MarketplaceId string, ASIN string, TimeOfOfferChange string"
OFFER_SCHEMA = T.StructType([
    T.StructField("IsBuyBoxWinner", T.StringType()),
    T.StructField("SellerId", T.StringType()),
    T.StructField("IsFeaturedMerchant", T.StringType()),
    T.StructField("IsFulfilledByAmazon", T.StringType()),
    T.StructField("ShipsDomestically", T.StringType()),
    T.StructField("SubCondition", T.StringType()),
    T.StructField("ListingPrice", T.StructType([T.StructField("Amount", T.DoubleType())])),
    T.StructField("Shipping", T.StructType([T.StructField("Amount", T.DoubleType())])),
    T.StructField("ShippingTime", T.StructType([
        T.StructField("_minimumHours", T.IntegerType()),
        T.StructField("_maximumHours", T.IntegerType()),
        T.StructField("_availabilityType", T.StringType())])),
    T.StructField("ShipsFrom", T.StructType([T.StructField("Country", T.StringType()),
                                             T.StructField("State", T.StringType())])),
    T.StructField("SellerFeedbackRating", T.StructType([
        T.StructField("SellerPositiveFeedbackRating", T.IntegerType()),
        T.StructField("FeedbackCount", T.IntegerType())])),
])
REQUIRED = ("IsBuyBoxWinner", "IsFeaturedMerchant", "IsFulfilledByAmazon", "ShipsDomestically")
_CHECK_SCHEMA = "_x string, _corrupt string"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _section(text: Column, tag: str) -> Column:
    return F.regexp_extract(text, rf"(?s)(<{tag}\b[^>]*>.*?</{tag}>)", 1)


def read_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: every ``*.xml`` under ``path`` (recursively), one row per file.

    Spark packs files to tasks by size (``spark.sql.files.maxPartitionBytes``), so very
    many small ones make few tasks.
    """
    return (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.xml").text(path)
            .select(F.col("value").alias("xml"), F.col("_metadata.file_path").alias("path")))


def parse_notifications(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 + S2 on (xml, path) rows: (offers in the offers schema, quarantine).

    Works on batch and streaming frames alike (no actions inside).
    """
    doc = files.select(
        "path", file_stem("path").alias("CompetitionName"),
        F.from_xml("xml", _CHECK_SCHEMA, _PERMISSIVE)["_corrupt"].isNotNull().alias("_broken"),
        ((_section(F.col("xml"), "NotificationMetaData") == "")
         | (_section(F.col("xml"), "OfferChangeTrigger") == "")).alias("_headless"),
        F.from_xml(_section(F.col("xml"), "NotificationMetaData"), HEADER_SCHEMA).alias("meta"),
        F.from_xml(_section(F.col("xml"), "OfferChangeTrigger"), TRIGGER_SCHEMA).alias("trig"),
        F.regexp_extract_all("xml", F.lit(r"(?s)(<Offer\b[^>]*>.*?</Offer>)"), 1).alias("frags"))
    time_txt = F.col("trig.TimeOfOfferChange")
    doc = doc.withColumn("Time", seconds_since_2016(time_txt))
    doc = doc.withColumn("parsed", F.transform("frags", lambda fr: F.struct(
        F.from_xml(fr, OFFER_SCHEMA).alias("o"),
        fr.rlike(r"<ConditionNotes\b").cast("int").alias("notes"))))

    def bad(p: Column) -> Column:
        m = p["o"].isNull()
        for r in REQUIRED:
            m = m | p["o"][r].isNull()
        return m

    # the whole file fails when its document, a header, its time or any offer is bad;
    # decided on the file row itself (works on streams, no window)
    doc = doc.withColumn("_file_bad", F.col("_broken") | F.col("_headless") | F.col("Time").isNull()
                         | F.exists("parsed", bad))
    quarantine = doc.where("_file_bad").select("path", "CompetitionName")
    rows = (doc.where(~F.col("_file_bad"))
               .select("meta", "trig", "Time", "CompetitionName", F.explode("parsed").alias("p"))
               .select("*", F.col("p.o").alias("o"), F.col("p.notes").alias("notes")))
    o = F.col("o")
    cust = F.coalesce(F.col("meta.SellerId"), F.lit(""))
    seller = F.coalesce(o["SellerId"], F.lit(""))
    offers = rows.select(
        flag(o["IsBuyBoxWinner"], 1, -1).alias("IsBuyBoxWinner"),
        F.coalesce(F.col("trig.MarketplaceId"), F.lit("")).alias("MarketplaceId"),
        F.coalesce(F.col("trig.ASIN"), F.lit("")).alias("ProductId"),
        seller.alias("SellerId"),
        F.col("notes").alias("ConditionNotes"),
        flag(o["IsFeaturedMerchant"]).alias("IsFeaturedMerchant"),
        flag(o["IsFulfilledByAmazon"]).alias("IsFulfilledByAmazon"),
        F.coalesce(o["ListingPrice"]["Amount"], F.lit(-1.0)).alias("ListingPrice"),
        F.coalesce(o["Shipping"]["Amount"], F.lit(-1.0)).alias("ShippingPrice"),
        F.coalesce(o["ShippingTime"]["_maximumHours"], F.lit(-1)).alias("ShippingTime_maxHours"),
        F.coalesce(o["ShippingTime"]["_minimumHours"], F.lit(-1)).alias("ShippingTime_minHours"),
        F.coalesce(o["ShippingTime"]["_availabilityType"], F.lit("")).alias("ShippingTime_availtype"),
        flag(o["ShipsDomestically"]).alias("ShipsDomestically"),
        F.coalesce(o["ShipsFrom"]["Country"], F.lit("")).alias("ShipsFromCountry"),
        F.coalesce(o["ShipsFrom"]["State"], F.lit("")).alias("ShipsFromState"),
        F.coalesce(o["SellerFeedbackRating"]["SellerPositiveFeedbackRating"], F.lit(-1))
         .alias("SellerFeedbackRating"),
        F.coalesce(o["SellerFeedbackRating"]["FeedbackCount"], F.lit(-1)).alias("SellerFeedbackCount"),
        F.coalesce(o["SubCondition"], F.lit("")).alias("SubCondition"),
        is_customer(seller, cust).alias("IsCustomer"),
        F.col("Time"),
        F.col("CompetitionName"))
    return offers, quarantine


def read_notifications(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Folder of notification XML -> (offers, quarantined files)."""
    return parse_notifications(read_files(spark, path))


LEDGER = "path string, length long, modified timestamp"


class NotificationLedger:
    """S1 again and again over one growing folder: files that were read are not read again.

    The ledger is an ``EpochTable`` of (path, length, modification time) in ``root``.
    ``new_files`` lists the folder and leaves out what the ledger has; ``commit`` adds files
    once their offers are written.  A file that was written anew is read again.
    """

    def __init__(self, spark: SparkSession, folder: str, root: str):
        from bidscope.streaming.tables import EpochTable
        self.spark, self.folder = spark, folder
        self.table = EpochTable(spark, root, T._parse_datatype_string(LEDGER), ["path"])

    def listed(self) -> DataFrame:
        """All ``*.xml`` of the folder; file contents are not opened."""
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml")
                .load(self.folder).select("path", "length", F.col("modificationTime").alias("modified")))

    def new_files(self) -> DataFrame:
        return self.listed().join(self.table.read(), ["path", "length", "modified"], "left_anti")

    def read_new(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(offers, quarantine, files) of the files that are new; pass ``files`` to ``commit``."""
        files = cut_lineage(self.new_files())
        paths = [r["path"] for r in files.select("path").toLocalIterator()]      # file names, as Spark's own listing
        if not paths:
            empty = self.spark.createDataFrame([], "xml string, path string")
            return (*parse_notifications(empty), files)
        return (*parse_notifications(read_files(self.spark, paths)), files)

    def commit(self, files: DataFrame) -> bool:
        """Note ``files`` as read; False when there are none."""
        if files.isEmpty():
            return False
        return self.table.write(files, self.table.last_epoch() + 1)
