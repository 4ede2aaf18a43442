"""Group-relative values ("transform" over a whole group) at scale.

Every per-auction / per-product value in the pipeline is a statistic of
the row's group (min, max, count, ...) combined with the row itself.  Two
physical shapes:

* ``"join"``: ``groupBy().agg()`` joined back on the key.  The aggregate
  is partial (map-side combine), so a hot group holding a third of all
  rows is reduced before the shuffle; the join back has one stats row per
  key, so AQE can split a skewed key on the big side, and it becomes a
  broadcast join by itself when the stats side is measured small.  Used
  for unbounded groups: products, markets, sellers.
* ``"window"``: an unordered ``Window.partitionBy(key)``.  One shuffle
  serves every statistic of the same key (consecutive windows reuse the
  partitioning) and the input is read once.  Used for auctions, which
  are bounded by the data model (one notification lists at most the 20
  lowest offers), where chained join rounds would re-read the input once
  per round.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys whose groups are bounded by the data model -> window strategy.
BOUNDED_KEYS = {("CompetitionName",), ("CompetitionName", "clf")}
STRATEGY = {"default": None}  # None: choose per key; or force "join"/"window"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_stats(df: DataFrame, keys: str | Sequence[str],
                aggs: Mapping[str, Column]) -> DataFrame:
    """One row per group with the named aggregates."""
    return df.groupBy(*_keys(keys)).agg(*[e.alias(n) for n, e in aggs.items()])


def with_group_stats(df: DataFrame, keys: str | Sequence[str],
                     aggs: Mapping[str, Column], strategy: str | None = None) -> DataFrame:
    """Append group aggregates to every row of the group.

    Rows whose key is null get null statistics (pandas drops null keys
    from ``groupby`` as well).
    """
    ks = _keys(keys)
    clash = [n for n in aggs if n in df.columns]
    if clash:
        df = df.drop(*clash)
    strategy = strategy or STRATEGY["default"] or (
        "window" if tuple(ks) in BOUNDED_KEYS else "join")
    if strategy == "window":
        w = Window.partitionBy(*ks)
        return df.select("*", *[e.over(w).alias(n) for n, e in aggs.items()])
    return df.join(group_stats(df, ks, aggs), on=ks, how="left")


def minmax_expr(x: Column, lo: Column, hi: Column, constant: float = 1.0) -> Column:
    """(x - lo) / (hi - lo); ``constant`` when the group has one value."""
    return F.when(hi == lo, F.lit(float(constant))).otherwise((x - lo) / (hi - lo))
