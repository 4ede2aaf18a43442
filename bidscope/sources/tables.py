"""Offer tables, market partitions, feature frames and result sinks
(S4-S8, S11-S13).  Parquet is the default storage; CSV where the original
format is CSV.  Writers never overwrite the path they were read from."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.operators.metrics import market_sizes
from bidscope.schema import AUCTION, MARKET, OFFER_SCHEMA

CORRUPT = "_corrupt_record"


def read_offers_csv(spark: SparkSession, path: str,
                    schema: T.StructType = OFFER_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Header CSV with an explicit schema (never inferred).

    PERMISSIVE with a corrupt-record column.  A flagged line is parsed once
    more as text fields: with a field too many, or a field that is there but
    does not parse, it is bad; otherwise it was only short and stays with
    nulls, as pandas pads it.  Returns (good rows, bad raw lines).
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    # without column pruning: a pruned parser does not see that a line is too long
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
          .option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(path))
    names = [f"f{i}" for i in range(len(schema.fields) + 1)]
    raw = F.from_csv(F.col(CORRUPT), ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE"})
    df = df.withColumn("_raw", raw)
    broken = F.col("_raw")[names[-1]].isNotNull()
    for n, f in zip(names, schema.fields):
        if not isinstance(f.dataType, T.StringType):
            broken = broken | (F.col("_raw")[n].isNotNull() & F.col(f.name).isNull())
    flagged = F.col(CORRUPT).isNotNull() & broken
    return (df.where(~flagged).drop(CORRUPT, "_raw"), df.where(flagged).select(F.col(CORRUPT).alias("line")))


def _plain(path: str) -> str:
    """Path without scheme and doubled slashes, to compare spellings."""
    return re.sub(r"/+", "/", re.sub(r"^file:", "", path)).rstrip("/")


def _guard(df: DataFrame, path: str) -> None:
    """Refuse to write where the frame is read from."""
    target = _plain(path)
    for p in map(_plain, [] if df.isStreaming else df.inputFiles()):
        if p == target or p.startswith(target + "/"):
            raise ValueError(f"refusing to overwrite the input {path}")


def write_offers(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Offers table to parquet (default) or CSV with header."""
    _guard(df, path)
    w = df.write.mode(mode)
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def write_markets(df: DataFrame, path: str, mode: str = "errorifexists", files: int = 8) -> DataFrame:
    """One partition directory per MarketplaceId; returns A3 sizes.

    Each market is dealt to ``files`` tasks by a hash of the row, so a large
    market is neither one task nor one file.
    """
    _guard(df, path)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, F.col(MARKET), salt).write.mode(mode).partitionBy(MARKET).parquet(path)
    return market_sizes(df)


def read_markets(spark: SparkSession, path: str, markets: list[str] | None = None) -> DataFrame:
    """All market partitions (partition discovery); ``markets`` prunes
    partitions at planning time."""
    df = spark.read.parquet(path)
    return df.where(F.col(MARKET).isin(markets)) if markets else df


def write_feature_frame(df: DataFrame, path: str, market_col: str = MARKET,
                        mode: str = "errorifexists", files: int = 8) -> None:
    """Per-market training frame, partitioned by market.

    Each market is dealt to ``files`` tasks by auction, so its files are neither one nor
    one per task, and an auction is in one file.
    """
    _guard(df, path)
    key = F.xxhash64(AUCTION) if AUCTION in df.columns else F.xxhash64(*df.columns)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, F.col(market_col), F.pmod(key, F.lit(files))).write.mode(mode).partitionBy(market_col).parquet(path)


def write_by_auction(df: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "errorifexists") -> None:
    """S8 by auction: a table of ``buckets`` buckets of auctions, sorted by auction, one file each.

    Read with ``spark.table``, its windows and aggregates by auction (W*, R2) need no
    exchange and no sort.  ``path`` names the folder of the files, else the warehouse.
    """
    if path is not None:
        _guard(df, path)
    w = (df.repartition(buckets, AUCTION).sortWithinPartitions(AUCTION).write.mode(mode)
         .bucketBy(buckets, AUCTION).sortBy(AUCTION).format("parquet"))
    (w if path is None else w.option("path", path)).saveAsTable(table)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature list, reprice list, reprice results: one write
    at job end (the original rewrote the result file per auction)."""
    _guard(df, path)
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
