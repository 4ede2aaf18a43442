"""Win events over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.functions.scalars import log_time
from bidscope.operators.clean import became_customer, winners
from bidscope.schema import AUCTION, MARKET, PRODUCT, TIME
from bidscope.session import cut_lineage

EVENT_KEYS = (MARKET, "WinnerId", PRODUCT)


#: A key with more wins than this is dealt to ranges of time.
HOT_KEY_ROWS = 1 << 20


def previous_win(wins: DataFrame, order: Sequence[str | Column] = ("Time",),
                 keys: Sequence[str] = EVENT_KEYS, hot_key_rows: int | None = None) -> DataFrame:
    """Pair each win with the previous win of the same (market, winner,
    product) in time order.

    Input: F7 rows (File, WinnerId, Time, MarketplaceId, ProductId,
    IsCustomer, LandedPrice).  Output: the previous win's File, Time,
    IsCustomer, LandedPrice and this win as Next / NextId / NextPrice;
    first wins of a key (no previous) are dropped.

    Keys are counted first, combined in the tasks.  Keys of at most ``hot_key_rows`` wins
    are windows behind one exchange.  The others, at most one in that many rows, are
    dealt to ranges of (key, time), so that one key fills many tasks.
    """
    cols = ("File", "Time", "IsCustomer", "LandedPrice")
    rows = wins.withColumn("_o", F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])).select(*keys, *cols, "_o")
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > (hot_key_rows or HOT_KEY_ROWS))
    hot = cut_lineage(hot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    if hot.isEmpty():
        prev = _windowed(rows, keys, cols)
    else:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        prev = _windowed(rows.join(hot, same, "left_anti"), keys, cols).unionByName(_ranged(rows.join(hot, same, "left_semi"), keys, cols))
    out = prev.select(*keys, *[F.col("_was")[c].alias(c) for c in cols], F.col("IsCustomer").alias("Next"),
                      F.col("File").alias("NextId"), F.col("LandedPrice").alias("NextPrice"))
    return out.dropna(how="any")


def _windowed(rows: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return rows.withColumn("_was", F.lag(F.struct(*cols)).over(Window.partitionBy(*keys).orderBy("_o"))).drop("_o")


def _ranged(rows: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Inside a range the previous row comes from a window; the first row of a key in a range
    takes the key's last row of the ranges before, from a table with one row per key and range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(n, *keys, "_o").withColumn("_part", F.spark_partition_id()))
    row = F.struct(*cols)
    here = Window.partitionBy("_part", *keys).orderBy("_o")
    before = Window.partitionBy(*keys).orderBy("_part")
    ends = (dealt.groupBy(*keys, "_part").agg(F.max(F.struct("_o", row.alias("r"))).alias("_last"))
            .withColumn("_carry", F.lag("_last.r").over(before))
            .where(F.col("_carry").isNotNull()).drop("_last"))
    near = dealt.withColumn("_near", F.lag(row).over(here)).join(ends, on=[*keys, "_part"], how="left")
    return near.withColumn("_was", F.coalesce("_near", "_carry")).drop("_near", "_carry", "_part", "_o")


def select_reprice_events(offers: DataFrame, time_col: str = TIME,
                          tiebreak: Sequence[str] = ()) -> DataFrame:
    """F7 -> P7 -> W9 -> F10 -> (File, LandedPrice, NextId, NextPrice).

    Auctions where a seller other than us won, followed by our win of the
    same product in the same market: the repricing events to back-test.
    ``tiebreak`` adds columns to the time order (carried through F7).
    """
    src = offers
    if time_col != TIME:
        src = src.withColumn(TIME, F.col(time_col))
    wins = winners(src, carry=tiebreak)
    wins = wins.withColumn("Time", log_time("Time") if time_col == TIME else F.col("Time"))
    order = ["Time", "File", *tiebreak]
    ev = previous_win(wins, order)
    return became_customer(ev).select("File", "LandedPrice", "NextId", "NextPrice")


def offers_of_events(offers: DataFrame, events: DataFrame) -> DataFrame:
    """Offers of the auctions on the reprice list (left semi join)."""
    return offers.join(events.select(F.col("File").alias(AUCTION)).distinct(),
                       on=AUCTION, how="left_semi")


def drop_auctions(offers: DataFrame, bad: DataFrame) -> DataFrame:
    """Remove the auctions listed in ``bad`` (left anti join)."""
    return offers.join(bad.select(AUCTION), on=AUCTION, how="left_anti")


def attach_next_event(results: DataFrame, events: DataFrame) -> DataFrame:
    """NextFile / NextPrice of each result's File (left equi join)."""
    nxt = events.select("File", F.col("NextId").alias("NextFile"), "NextPrice")
    return results.join(nxt, on="File", how="left")
