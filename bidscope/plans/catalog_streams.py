"""Streaming queries: T2 and T3 over the ``events`` table as a file stream, T4 over the offers.

Each query runs its stream to the end of the files there are and returns the
table that the stream's sink has written into the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.operators.reprice import reprice
from bidscope.plans.auction_view import load
from bidscope.plans.catalog import query
from bidscope.plans.catalog_reprice import R5_SQL
from bidscope.schema import AUCTION
from bidscope.session import checkpoint_dir
from bidscope.streaming.notifications import dedup_notifications, recommend_stream, running_product_min, upsert_stream
from bidscope.streaming.tables import EpochTable


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")


def _root(spark: SparkSession) -> str:
    """A folder of its own in the shared folder, removed when the driver's JVM ends."""
    root = f"{checkpoint_dir(spark)}/bidscope-stream-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


def _appended(stream: DataFrame) -> DataFrame:
    """Run the stream over all files; its rows as a table."""
    spark = stream.sparkSession
    root = _root(spark)
    table = EpochTable(spark, f"{root}/table", stream.schema)
    (stream.writeStream.foreachBatch(lambda batch, epoch: table.write(batch, epoch)).option("checkpointLocation", f"{root}/state")
     .trigger(availableNow=True).start().awaitTermination())
    return table.read()


@query("t2_dedup_stream", """
select event_id, user_id, event_type, round(value, 6) as value from events""", view=False)
def q_t2(spark, sf_dir):
    """The event stream delivered twice, repeats dropped within the watermark."""
    events = _event_stream(spark, sf_dir).withColumn("event_time", F.col("ts").cast("timestamp"))
    twice = events.unionByName(events)
    once = dedup_notifications(twice, "1 hour", ["event_id"], "event_time")
    return _appended(once.select("event_id", "user_id", "event_type", "value"))


@query("t3_running_minimum", """
select user_id as ProductId, round(min(value), 6) as min_landed, count(*) as n_offers from events group by 1""",
       view=False)
def q_t3(spark, sf_dir):
    """Current minimum per key in a table, only changed keys written per micro-batch
    (user = product, value = price)."""
    offers = _event_stream(spark, sf_dir).select(F.col("user_id").alias("ProductId"), F.col("value").alias("ListingPrice"),
                                                 F.lit(0.0).alias("ShippingPrice"))
    changes, root = running_product_min(offers), _root(spark)
    table = EpochTable(spark, f"{root}/table", changes.schema, ["ProductId"])
    upsert_stream(changes, table, f"{root}/state").awaitTermination()
    return table.read()


@query("t4_recommend_stream", R5_SQL)
def q_t4(offers):
    """T4: the offers arrive in files of whole auctions, a quarter of them a micro-batch; each is repriced
    and committed once.  The result is that of the batch job (R5)."""
    spark = offers.sparkSession
    root = _root(spark)
    offers.repartition(AUCTION).write.parquet(f"{root}/landing")
    history = spark.read.schema(offers.schema).parquet(f"{root}/landing")
    files = -(-len(history.inputFiles()) // 4)
    landed = spark.readStream.schema(offers.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landing")
    table = EpochTable(spark, f"{root}/table", reprice(history, prob=0.5, degree=1).schema)
    recommend_stream(landed, table, f"{root}/state", history, 0.5, 1).awaitTermination()
    return table.read()
