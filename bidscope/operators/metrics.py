"""Aggregations (A1-A12): sizes, confusion matrices, class scores,
summaries.  All are single aggregates with partial (map-side) combine;
quantiles use the distributed exact ranking in ``ranking.py``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.schema import AUCTION, MARKET

LABELS = (-1, 1)


def market_sizes(df: DataFrame, market: str = MARKET) -> DataFrame:
    """A3: rows per market plus a total row (market null)."""
    return df.rollup(market).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: number of distinct values of each column, one row.

    One scan: every row becomes (column number, value as text) rows, which are
    made distinct with map-side combining and counted per column.
    """
    each = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)])
    values = df.select(F.explode(each).alias("e")).select("e.c", "e.v").where(F.col("v").isNotNull()).distinct()
    return values.agg(*[F.sum((F.col("c") == i).cast("long")).alias(f"distinct_{c}") for i, c in enumerate(cols)]) \
                 .na.fill(0)


#: Fixed value: relative standard error of a HyperLogLog sketch of 2**k registers is about this over 2**(k/2).
HLL_ERROR = 1.04


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """A4, approximate: (group, column, sketch) of a HyperLogLog sketch of each column's values.

    Sketches are a few kilobytes whatever the data, are built in the tasks and can be kept
    with each part of a table and merged later (``union_distinct``).
    """
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    values = df.select(*by, F.explode(each).alias("e")).select(*by, "e.column", "e.v").where("v is not null")
    return values.groupBy(*by, "column").agg(F.hll_sketch_agg("v", F.lit(lg_k)).alias("sketch"))


def union_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(group, column, n_distinct) estimated from the union of kept sketches."""
    return sketches.groupBy(*by, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str,
                     labels: Sequence[int] = LABELS) -> DataFrame:
    """A5: long form (actual, predicted, n) over all label pairs, zeros
    included, labels sorted."""
    spark = df.sparkSession
    labs = sorted(labels)
    grid = (spark.range(1)
            .select(F.explode(F.array(*[F.lit(x) for x in labs])).alias("actual"))
            .select("actual", F.explode(F.array(*[F.lit(x) for x in labs])).alias("predicted")))
    counts = (df.groupBy(F.col(actual).cast("int").alias("actual"),
                         F.col(predicted).cast("int").alias("predicted"))
                .agg(F.count(F.lit(1)).alias("n")))
    return (grid.join(counts, on=["actual", "predicted"], how="left")
                .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def confusion_wide(df: DataFrame, actual: str, predicted: str,
                   labels: Sequence[int] = LABELS) -> DataFrame:
    """A5 as a matrix: one row per actual label, one column per predicted."""
    return (df.groupBy(F.col(actual).cast("int").alias("actual"))
              .pivot(predicted, list(sorted(labels))).count().fillna(0))


def class_scores(df: DataFrame, actual: str, predicted: str,
                 labels: Sequence[int] = LABELS) -> DataFrame:
    """(label, precision, recall, f1, support); 0 where undefined.

    One aggregate of conditional counts, then one row per label.
    """
    a, p = F.col(actual), F.col(predicted)
    aggs = []
    for i, c in enumerate(labels):
        aggs += [F.sum(((a == c) & (p == c)).cast("long")).alias(f"tp{i}"),
                 F.sum((p == c).cast("long")).alias(f"pp{i}"),
                 F.sum((a == c).cast("long")).alias(f"ap{i}")]
    counts = df.agg(*aggs)
    rows = []
    for i, c in enumerate(labels):
        tp = F.coalesce(F.col(f"tp{i}"), F.lit(0)).cast("double")
        pp = F.coalesce(F.col(f"pp{i}"), F.lit(0)).cast("double")
        ap = F.coalesce(F.col(f"ap{i}"), F.lit(0)).cast("double")
        prec = F.when(pp > 0, tp / pp).otherwise(0.0)
        rec = F.when(ap > 0, tp / ap).otherwise(0.0)
        rows.append(F.struct(F.lit(int(c)).alias("label"), prec.alias("precision"),
                             rec.alias("recall"), ap.cast("long").alias("support")))
    out = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return out.select("label", "precision", "recall", f1.alias("f1"), "support")


def classification_report(df: DataFrame, actual: str, predicted: str,
                          labels: Sequence[int] = LABELS) -> DataFrame:
    """A6 per class plus a support-weighted 'avg / total' row."""
    sc = class_scores(df, actual, predicted, labels)
    per = sc.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                    "support")
    tot = sc.agg(
        F.lit("avg / total").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").cast("long").alias("support"))
    return per.unionByName(tot)


def f1_product(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Product of the per-class F1 scores (selection score).

    exp(sum(ln f1)) with a zero F1 giving 0.
    """
    g = scores.groupBy(*by) if by else scores
    return g.agg(F.when(F.min("f1") <= 0, 0.0)
                 .otherwise(F.exp(F.sum(F.log(F.when(F.col("f1") > 0, F.col("f1")))))).alias("f1_product"))


def histogram(df: DataFrame, col: str, lo: float, width: float,
              by: Sequence[str] = ()) -> DataFrame:
    """Counts per fixed-width bin; bin i covers [lo + i w, lo + (i+1) w)."""
    b = F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("long")
    return (df.where(F.col(col).isNotNull())
              .groupBy(*by, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width)))


def feature_correlation(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (MARKET,)) -> DataFrame:
    """A10: Pearson correlation of every feature pair, per market, long form
    (market, a, b, corr) from one aggregate per market."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_r{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return agg.select(*by, F.explode(rows).alias("r")).select(*by, "r.a", "r.b", "r.corr")


def repeat_stats(scores: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean and sample std of a score over repeats."""
    return scores.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                                   F.count(F.lit(1)).alias("repeats"))


def auction_count(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """A4 on auctions: number of distinct auctions."""
    return df.select(group).distinct().agg(F.count(F.lit(1)).alias("n_auctions"))
