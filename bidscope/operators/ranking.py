"""Exact global ranks and quantiles without a single-partition window.

Ranks: a global ``row_number() over (order by ...)`` funnels every row into
one task.  Instead: range-partition on the sort key (Spark samples the key
to cut balanced ranges), sort inside partitions, number rows with
``monotonically_increasing_id`` (partition index in the high bits, row
index in the low 33 bits), checkpoint so ids and partitions are fixed,
then add each partition's offset, computed from one count per partition
(a few hundred numbers on the driver).

Quantiles need no order of all rows.  A few counting passes narrow the range of
values around each wanted rank: one aggregate counts a histogram per group,
the bucket that holds the rank is the next range, and what is left is small
enough to be ordered.  A hot group is counted in all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidscope.session import cut_lineage


def _cols(xs) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str = "_rank",
                partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Append a 0-based rank of every row in ``order`` (ties broken by
    position, so ranks are unique); ``total`` names an optional column
    holding the row count (known from the per-partition counts)."""
    res, n = global_rank_count(df, order, out, partitions)
    return res.withColumn(total, F.lit(n).cast("long")) if total else res


def global_rank_count(df: DataFrame, order: Sequence[str | Column], out: str = "_rank",
                      partitions: int | None = None) -> tuple[DataFrame, int]:
    """``global_rank`` plus the exact row count (summed per-partition counts)."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(order)
    s = (df.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    counts = sorted((r["_pid"], r["n"]) for r in
                    s.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    res = (s.join(F.broadcast(off), on="_pid", how="left")   # one row per partition
             .withColumn(out, F.col("_off") + local)
             .drop("_pid", "_mid", "_off"))
    return res, acc


#: A range with at most this many rows of one group is ordered by a window instead of a histogram.
DIRECT = 1 << 16
BUCKETS = 2048
#: Up to this many rows of state travel as a local table, more of them as a checkpoint.
LOCAL_ROWS = 10_000


def _held(df: DataFrame) -> DataFrame:
    """A small table computed once: local where it is within ``LOCAL_ROWS``."""
    rows = df.limit(LOCAL_ROWS + 1).collect()
    if len(rows) > LOCAL_ROWS:
        return cut_lineage(df)
    return df.sparkSession.createDataFrame(rows, df.schema)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def _narrowed(src: DataFrame, by: list[str], ranges: DataFrame, buckets: int) -> DataFrame:
    """Ranges with the buckets of theirs that hold a wanted rank.

    A range is (group, _lo, _hi, _before, _m, _ranks): its least and greatest value, the
    rows below it and in it, the wanted 0-based ranks in it.  The bucket of a value
    grows with it, so a bucket's least and greatest value tell exactly which rows it
    has; one aggregate counts all groups' buckets, combined in the tasks first.
    """
    names = [f"_j{i}" for i in range(len(by))]
    r = ranges.withColumnsRenamed(dict(zip(by, names)))
    inside = src.join(r, _same(by, names) & (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    x, lo, hi = (F.col(c) / 2 for c in ("_x", "_lo", "_hi"))      # halves: the width cannot overflow (it may vanish)
    part = F.floor(F.try_divide(x - lo, hi - lo) * buckets)
    bucket = (F.when(F.col("_x") == F.col("_lo"), 0).when(F.col("_x") == F.col("_hi"), buckets - 1)
              .when(F.col("_lo") == float("-inf"), F.when(F.col("_hi") == float("inf"), buckets // 2).otherwise(buckets - 2))
              .when(F.col("_hi") == float("inf"), 1)
              .otherwise(F.least(F.greatest(part, F.lit(0)), F.lit(buckets - 1))))
    counts = (inside.groupBy(*by, "_lo", bucket.cast("int").alias("_b"))
              .agg(F.count(F.lit(1)).alias("_m"), F.min("_x").alias("_least"), F.max("_x").alias("_most"),
                   F.first("_before").alias("_before"), F.first("_ranks").alias("_ranks")))
    run = Window.partitionBy(*by, "_lo").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    at = counts.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_m").over(run), F.lit(0)))
    kept = at.withColumn("_ranks", F.expr("filter(_ranks, r -> r >= _before and r < _before + _m)")).where(F.size("_ranks") > 0)
    return kept.select(*by, F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), "_before", "_m", "_ranks")


def select_ranks(src: DataFrame, by: Sequence[str], ranges: DataFrame, direct: int | None = None,
                 buckets: int | None = None) -> DataFrame:
    """(group, _rank, _value) of the wanted ranks, without sorting the rows.

    Every pass is one aggregate over ``src``; each narrows the ranges of groups with more
    than ``direct`` rows by a histogram of ``buckets``.  What is left of a range, at most
    ``direct`` rows of a group, is ordered by a window.
    """
    by, direct, buckets = list(by), direct or DIRECT, buckets or BUCKETS
    done, wide = None, ranges
    while True:
        small = wide.where((F.col("_m") <= direct) | (F.col("_lo") == F.col("_hi")))
        done = small if done is None else done.unionByName(small)
        wide = wide.where((F.col("_m") > direct) & (F.col("_lo") < F.col("_hi")))
        if wide.isEmpty():
            break
        wide = _held(_narrowed(src, by, wide, buckets))
    flat = done.where("_lo = _hi").select(*by, F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_value"))
    names = [f"_j{i}" for i in range(len(by))]
    r = done.where("_lo < _hi").withColumnsRenamed(dict(zip(by, names)))
    inside = src.join(r, _same(by, names) & (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    place = F.row_number().over(Window.partitionBy(*by, "_lo").orderBy("_x")) - 1
    found = (inside.withColumn("_rank", F.col("_before") + place).where(F.array_contains("_ranks", F.col("_rank")))
             .select(*by, "_rank", F.col("_x").alias("_value")))
    return flat.unionByName(found)


def _lerp(a: Column, b: Column, t: Column) -> Column:
    # NumPy's linear interpolation, including its t >= 0.5 branch
    return F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)


def _quantiles(src: DataFrame, base: DataFrame, probs: Sequence[float], by: list[str]) -> DataFrame:
    """``base`` (group, _n, _min, _max and more columns) with the quantiles of ``src``'s _x."""
    place = [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    low = [F.floor(h).cast("long") for h in place]
    ranks = F.array_distinct(F.array(*low, *[F.least(x + 1, F.col("_n") - 1) for x in low]))
    ranges = base.where("_n > 0").select(*by, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), F.lit(0).cast("long").alias("_before"),
                                         F.col("_n").alias("_m"), ranks.alias("_ranks"))
    values = select_ranks(src, by, ranges)
    names = [f"_j{i}" for i in range(len(by))]
    maps = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    both = base.join(maps.withColumnsRenamed(dict(zip(by, names))), _same(by, names), "left")
    outs = []
    for p, h, x in zip(probs, place, low):
        a, b = F.col("_at")[x], F.col("_at")[F.least(x + 1, F.col("_n") - 1)]
        outs.append(_lerp(a, b, h - x).alias(f"q{int(round(p * 100))}"))
    return both.select(*[c for c in base.columns], *outs)


def _source(df: DataFrame, col: str, by: list[str]) -> tuple[DataFrame, list[str]]:
    """(group columns, _x) with a constant group where none is given; NaN counts as null."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double")).alias("_x")
    return (df.select(*by, x), by) if by else (df.select(F.lit(0).alias("_all"), x), ["_all"])


def _counted(src: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return _held(src.groupBy(*keys).agg(F.count("_x").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"), *more))


def quantiles(df: DataFrame, col: str, probs: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles of ``col`` (null and NaN ignored):
    one row per group with columns q<int(100 p)>, e.g. q25, q50, q75.

    ``df`` is read once for counts and ends, once per narrowing pass and once at the end;
    a dear ``df`` is best staged by the caller.
    """
    by = list(by)
    src, keys = _source(df, col, by)
    out = _quantiles(src, _counted(src, keys), probs, keys)
    names = [f"q{int(round(p * 100))}" for p in probs]
    return out.where("_n > 0").select(*by, *names) if by else out.select(*names)


def describe(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std (n-1), min, 25%, 50%, 75%, max of ``col``."""
    by = list(by)
    src, keys = _source(df, col, by)
    base = _counted(src, keys, F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"))
    out = _quantiles(src, base, [0.25, 0.5, 0.75], keys)
    return out.select(*by, F.col("_n").alias("count"), "mean", "std", F.col("_min").alias("min"), F.col("q25").alias("p25"),
                      F.col("q50").alias("p50"), F.col("q75").alias("p75"), F.col("_max").alias("max"))
