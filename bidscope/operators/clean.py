"""Filters and cleaning.

Column-level decisions (duplicate, constant, sparse columns) are each ONE
aggregate over the data; only the per-column verdicts (one small row)
reach the driver.  Row-level filters are group statistics joined back or
semi joins, so nothing is collected per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.operators.groups import group_stats, with_group_stats
from bidscope.schema import (AUCTION, CUSTOMER, ID_COLUMNS, LANDED, LISTING, MARKET,
                             PRODUCT, SELLER, SHIPPING, TIME, WINNER)
from bidscope.session import cut_lineage


def _type_family(dt: T.DataType) -> str:
    if isinstance(dt, T.IntegralType):
        return "integral"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "floating"
    return dt.simpleString()


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType, T.IntegralType, T.DecimalType))


def _equal_everywhere(a: str, b: str, dt: T.DataType) -> Column:
    ca, cb = F.col(a), F.col(b)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        # a NaN / null on either side makes the columns unequal
        same = F.coalesce((ca == cb) & ~F.isnan(ca) & ~F.isnan(cb), F.lit(False))
    elif _numeric(dt):
        same = F.coalesce(ca == cb, F.lit(False))
    else:
        same = ca.eqNullSafe(cb)
    return F.coalesce(F.bool_and(same), F.lit(True))


def _canonical(f: T.StructField) -> Column:
    """Equal for equal values of a family: longs, doubles without a negative zero."""
    c = F.col(f.name)
    if isinstance(f.dataType, T.IntegralType):
        return c.cast("long")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return c.cast("double") + F.lit(0.0)
    return c


def _unequal_to_all(f: T.StructField) -> Column:
    """A number that is null or NaN equals nothing, so its column has no copy."""
    c = F.col(f.name)
    if not _numeric(f.dataType):
        return F.lit(False)
    missing = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c.isNull()
    return F.coalesce(F.bool_or(missing), F.lit(False))


ROW = "_row_of_column_prints"


def _numbered(df: DataFrame) -> DataFrame:
    """Every row with a number of its own; the same for all columns of one pass is all that is asked."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def _fingerprints(fields: Sequence[T.StructField]) -> list[Column]:
    """Per column an order-free sum (xor) of the hashes of (row, value), and whether it can have a copy.
    The frame carries ``ROW`` (``_numbered``)."""
    row = F.col(ROW)
    out = []
    for i, f in enumerate(fields):
        out += [F.bit_xor(F.xxhash64(row, _canonical(f))).alias(f"_f{i}"), (~_unequal_to_all(f)).alias(f"_u{i}")]
    return out


def _duplicates(df: DataFrame, fields: Sequence[T.StructField], prints) -> list[str]:
    """Columns that equal a later one: those of equal fingerprints are compared, each with
    the next, in one more aggregate; a group that a chance hit has joined pair by pair."""
    groups: dict = {}
    for i, f in enumerate(fields):
        if prints[f"_u{i}"]:
            groups.setdefault((_type_family(f.dataType), prints[f"_f{i}"]), []).append(f)
    groups = [g for g in groups.values() if len(g) > 1]

    def equal(pairs):
        if not pairs:
            return []
        return list(df.agg(*[_equal_everywhere(a.name, b.name, a.dataType).alias(f"_e{i}") for i, (a, b) in enumerate(pairs)]).first())

    chain = [[(a, b) for a, b in zip(g, g[1:])] for g in groups]
    said = iter(equal([p for c in chain for p in c]))
    out, open_ = [], []
    for g, c in zip(groups, chain):
        if all([next(said) for _ in c]):
            out += [f.name for f in g[:-1]]
        else:
            open_.append(g)
    pairs = [(a, b) for g in open_ for i, a in enumerate(g) for b in g[i + 1:]]
    out += [a.name for (a, _), same in zip(pairs, equal(pairs)) if same]
    return [f.name for f in fields if f.name in set(out)]


def duplicate_column_report(df: DataFrame, protect: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """F1 as a table: (column, duplicate) for every candidate column.

    Among same-typed columns other than the ids, a column is a duplicate
    when it equals some LATER column on every row (so the last copy
    survives).  One aggregate of a fingerprint per column; only columns of equal
    fingerprints are compared value by value.
    """
    fields = [f for f in df.schema.fields if f.name not in protect]
    shape = "column string, duplicate boolean"
    if not fields:
        return df.sparkSession.createDataFrame([], shape)
    gone = set(_duplicates(df, fields, _numbered(df).agg(*_fingerprints(fields)).first()))
    return df.sparkSession.createDataFrame([(f.name, f.name in gone) for f in fields], shape)


def duplicate_columns(df: DataFrame, protect: Sequence[str] = ID_COLUMNS) -> list[str]:
    """names of duplicate columns (one row per column to the driver)."""
    return [r["column"] for r in duplicate_column_report(df, protect).collect() if r["duplicate"]]


def drop_duplicate_columns(df: DataFrame, protect: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """drop every column equal to a later same-typed column."""
    return df.drop(*duplicate_columns(df, protect))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """full-row distinct (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def _profile_exprs(df: DataFrame) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"_c{i}")]
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            aggs += [F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")]
    return aggs


def column_profile(df: DataFrame) -> DataFrame:
    """One aggregate: row count and, per column, non-null count, min, max.

    Feeds F3 (constant) and F4 (sparse) without a distinct count per column.
    """
    return df.agg(*_profile_exprs(df))


def _profile_rows(df: DataFrame, profile: DataFrame, body) -> DataFrame:
    parts = []
    for i, f in enumerate(df.schema.fields):
        parts.append(F.struct(F.lit(f.name).alias("column"), *body(i, f)))
    return profile.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def constant_column_report(df: DataFrame, protect: Sequence[str] = ID_COLUMNS,
                           label: str | None = WINNER) -> DataFrame:
    """F3 as a table: (column, constant).

    A column is constant when it holds exactly one distinct value, null
    counted as a value: all null, or no null and min = max.  Ids and the
    label are never reported (the label is protected, quirk Q4).
    """
    return _constant_report(df, column_profile(df), protect, label)


def _constant_report(df: DataFrame, profile: DataFrame, protect: Sequence[str], label: str | None) -> DataFrame:
    keep = set(protect) | ({label} if label else set())

    def body(i, f):
        n, c = F.col("_n"), F.col(f"_c{i}")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            const = F.lit(False)
        else:
            lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
            const = (c == 0) | ((c == n) & (lo == hi))
        if f.name in keep:
            const = F.lit(False)
        return [F.coalesce(const, F.lit(False)).alias("constant")]

    return _profile_rows(df, profile, body)


def drop_constant_columns(df: DataFrame, protect: Sequence[str] = ID_COLUMNS,
                          label: str | None = WINNER) -> DataFrame:
    """drop single-valued columns."""
    drop = [r["column"] for r in constant_column_report(df, protect, label).collect() if r["constant"]]
    return df.drop(*drop)


def sparse_column_report(df: DataFrame, min_fraction: float = 0.9) -> DataFrame:
    """F4 as a table: (column, non_null, threshold, kept).

    Kept when non-null count >= int(min_fraction * rows).
    """
    def body(i, f):
        thr = F.floor(F.col("_n") * F.lit(min_fraction)).cast("long")
        return [F.col(f"_c{i}").alias("non_null"), thr.alias("threshold"),
                (F.col(f"_c{i}") >= thr).alias("kept")]

    prof = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(df.schema.fields)])
    return _profile_rows(df, prof, body)


def drop_sparse_columns(df: DataFrame, min_fraction: float = 0.9) -> DataFrame:
    """drop columns with fewer than int(0.9 n) non-null values."""
    drop = [r["column"] for r in sparse_column_report(df, min_fraction).collect() if not r["kept"]]
    return df.drop(*drop)


def auction_summary(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """A2: per auction winner count, offer count, customer count, min landed."""
    aggs = {"n_winners": F.sum((F.col(WINNER) == 1).cast("long")),
            "n_offers": F.count(F.lit(1))}
    if CUSTOMER in df.columns:
        aggs["n_customers"] = F.sum((F.col(CUSTOMER) == 1).cast("long"))
    if LANDED in df.columns:
        aggs["min_landed"] = F.min(LANDED)
    elif LISTING in df.columns and SHIPPING in df.columns:
        aggs["min_landed"] = F.min(F.col(LISTING) + F.col(SHIPPING))
    return group_stats(df, group, aggs)


def exactly_one_winner(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """keep auctions with exactly one winner row (group winner count)."""
    out = with_group_stats(df, group, {"_w": F.sum((F.col(WINNER) == 1).cast("long"))})
    return out.where(F.col("_w") == 1).drop("_w")


def bad_auctions(df: DataFrame, group: str = AUCTION) -> DataFrame:
    """Auctions with zero or several winners (for J2's anti join)."""
    return (df.groupBy(group).agg(F.sum((F.col(WINNER) == 1).cast("long")).alias("_w"))
              .where(F.col("_w") != 1).select(group))


def exactly_one_customer(df: DataFrame, group: str = AUCTION) -> tuple[DataFrame, DataFrame]:
    """(offers of auctions with exactly one customer row,
    rejected auctions with a reason)."""
    counts = df.groupBy(group).agg(F.sum((F.col(CUSTOMER) == 1).cast("long")).alias("_c"))
    rejected = counts.where(F.col("_c") != 1).select(
        group, F.when(F.col("_c") == 0, "no customer").otherwise("several customers").alias("reason"))
    kept = with_group_stats(df, group, {"_c": F.sum((F.col(CUSTOMER) == 1).cast("long"))})
    return kept.where(F.col("_c") == 1).drop("_c"), rejected


def winners(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """winning rows as (File, WinnerId, Time, MarketplaceId, ProductId,
    IsCustomer, LandedPrice) plus any ``carry`` columns."""
    landed = F.col(LANDED) if LANDED in df.columns else F.col(LISTING) + F.col(SHIPPING)
    return df.where(F.col(WINNER) == 1).select(
        F.col(AUCTION).alias("File"), F.col(SELLER).alias("WinnerId"), F.col(TIME).alias("Time"),
        MARKET, PRODUCT, CUSTOMER, landed.alias(LANDED), *carry)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """F8: remove rows with any null."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def became_customer(events: DataFrame) -> DataFrame:
    """the previous win was not ours and this win is ours."""
    return events.where((F.col("IsCustomer") == 0) & (F.col("Next") == 1))


def reject_outliers(df: DataFrame, col: str, by: Sequence[str] = (PRODUCT,),
                    m: float = 2.0) -> DataFrame:
    """keep rows with |x - median| / MAD < m per group; a group with
    MAD = 0 keeps all its rows.  Medians are exact and skew-safe
    (distributed ranks, see ``ranking.py``)."""
    from bidscope.operators.ranking import quantiles
    by = list(by)
    med = quantiles(df, col, [0.5], by).withColumnRenamed("q50", "_med")
    d = df.join(med, on=by, how="left").withColumn("_dev", F.abs(F.col(col) - F.col("_med")))
    mad = quantiles(d, "_dev", [0.5], by).withColumnRenamed("q50", "_mad")
    d = d.join(mad, on=by, how="left")
    keep = (F.col("_mad") == 0) | (F.col("_dev") / F.col("_mad") < F.lit(m))
    return d.where(keep).drop("_med", "_dev", "_mad")


def required_fields(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required fields, rows missing one)."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok), df.where(~ok)


def _row_hashes(df: DataFrame) -> list[Column]:
    """Rows are told apart by 128 bits of hash, ``_h1`` and ``_h2``."""
    values = [_canonical(f) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name) for f in df.schema.fields]
    nulls = [c.isNull() for c in values]          # a hash passes over nulls, so their places go in as well
    return [F.xxhash64(F.lit(k), *values, *nulls).alias(f"_h{k}") for k in (1, 2)]


def _distinct_counts(df: DataFrame, cols: Sequence[str]) -> tuple[int, list[int]]:
    """Distinct rows, and the non-null values of ``cols`` in them.

    An exchange moves two hashes and a bit a column instead of the rows.
    """
    rows = df.select(*_row_hashes(df), F.array(*[F.col(c).isNotNull() for c in cols]).alias("_there"))
    one = rows.groupBy("_h1", "_h2").agg(F.first("_there").alias("_there"))
    found = one.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col("_there")[i].cast("long")), F.lit(0)).alias(f"c{i}")
                                                    for i in range(len(cols))]).first()
    return found["n"], [found[f"c{i}"] for i in range(len(cols))]


def _distinct_counts_by_auction(df: DataFrame, cols: Sequence[str]) -> tuple[int, int, dict[str, int]]:
    """Distinct rows, those of auctions with exactly one winner among them, and the non-null values
    of ``cols`` in them.

    Copies of a row share its auction, so one exchange by auction brings both together; two
    hashes of the row, whether it won and a bit a column move.
    """
    rows = df.select(F.col(AUCTION).alias("_a"), *_row_hashes(df), (F.col(WINNER) == 1).alias("_won"),
                     *[F.col(c).isNotNull().alias(f"_v{i}") for i, c in enumerate(cols)])
    one = rows.repartition("_a").groupBy("_a", "_h1", "_h2").agg(
        F.first("_won").alias("_won"), *[F.first(f"_v{i}").alias(f"_v{i}") for i in range(len(cols))])
    auctions = one.groupBy("_a").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_won").cast("long")).alias("w"),
                                     *[F.sum(F.col(f"_v{i}").cast("long")).alias(f"c{i}") for i in range(len(cols))])
    found = auctions.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                         F.coalesce(F.sum(F.when(F.col("w") == 1, F.col("n"))), F.lit(0)).alias("n5"),
                         *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(cols))]).first()
    return found["n"], found["n5"], {c: found[f"c{i}"] for i, c in enumerate(cols)}


def _verdicts(df: DataFrame, protect: Sequence[str], label: str) -> tuple[Row, list[str], list[str]]:
    """(profile of the columns, duplicate columns, constant columns) of F1 and F3 from one aggregate
    over the input, one row to the driver, and one more where fingerprints are equal.  Neither
    verdict changes when duplicate rows are removed."""
    fields = [f for f in df.schema.fields if f.name not in protect]
    profiled = _numbered(df).agg(*_profile_exprs(df), *_fingerprints(fields))
    both = profiled.first()
    copies = _duplicates(df, fields, both) if fields else []
    profile = df.sparkSession.createDataFrame([both], profiled.schema)
    return both, copies, [r["column"] for r in _constant_report(df, profile, protect, label).collect() if r["constant"]]


def clean(df: DataFrame, min_fraction: float = 0.9, protect: Sequence[str] = ID_COLUMNS,
          label: str = WINNER) -> DataFrame:
    """F1 -> F2 -> F3 -> F4 -> F5, with the result of that order.

    Duplicate and constant columns are told by ``_verdicts``.  The
    sparse-column threshold (F4) counts rows after de-duplication; only columns with a null
    are counted, over hashes of the rows.  De-duplication and the winner filter (F5) are
    the lazy rest.
    """
    both, copies, constant = _verdicts(df, protect, label)
    gone = {*copies, *constant}
    kept = df.drop(*gone)
    holes, sparse = [f.name for i, f in enumerate(df.schema.fields) if f.name not in gone and both[f"_c{i}"] < both["_n"]], []
    if holes:
        n, counts = _distinct_counts(kept, holes)
        sparse = [c for c, k in zip(holes, counts) if k < int(min_fraction * n)]
    return exactly_one_winner(drop_duplicate_rows(kept).drop(*sparse))


def clean_report(df: DataFrame, min_fraction: float = 0.9, protect: Sequence[str] = ID_COLUMNS,
                 label: str = WINNER) -> DataFrame:
    """rows and columns before/after each cleaning step, dropped names.

    One row per step: (step, rows_before, rows_after, cols_before,
    cols_after, dropped).  Duplicate and constant columns are told by ``_verdicts``; the
    rows without copies, their values and those of auctions with one winner by one more
    aggregate, over hashes of the rows and not the rows.
    """
    spark = df.sparkSession
    both, copies, constant = _verdicts(df, protect, label)
    n0, names = both["_n"], list(df.columns)
    left1 = [c for c in names if c not in copies]
    left3 = [c for c in left1 if c not in constant]
    null = {f.name for i, f in enumerate(df.schema.fields) if both[f"_c{i}"] < n0}
    n2, n5, counts = _distinct_counts_by_auction(df.select(*left1), [c for c in left3 if c in null])
    least = int(min_fraction * n2)
    sparse = [c for c in left3 if c in counts and counts[c] < least]
    left4 = [c for c in left3 if c not in sparse]
    steps = [("duplicate_columns", n0, n0, len(names), len(left1), ",".join(c for c in names if c not in left1)),
             ("duplicate_rows", n0, n2, len(left1), len(left1), ""),
             ("constant_columns", n2, n2, len(left1), len(left3), ",".join(c for c in left1 if c not in left3)),
             ("sparse_columns", n2, n2, len(left3), len(left4), ",".join(sparse)),
             ("one_winner", n2, n5, len(left4), len(left4), "")]
    return spark.createDataFrame(
        steps, "step string, rows_before long, rows_after long, cols_before int, "
               "cols_after int, dropped string")
