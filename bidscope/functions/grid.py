"""Price-grid array functions (G1-G8) as higher-order Column expressions.

A grid is an ``array<double>`` column on the auction row; candidates are
made with ``explode`` (a lateral expansion of the auction's own grid, never
a cartesian product).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grid sizes of the recommendation search.
POINTS_UP_ONLY = 80    # lower bound equals the middle point
POINTS_DEFAULT = 50    # any other bounds
SPREAD = 0.1           # +-10 % around winner / customer price


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row.

    A column that a function of an array's elements names may be put into that
    function by the optimizer, and is then computed for every element.
    """
    return F.transform(F.array(value), use)[0]


def exploded(df, array: str, keep, pos: str = "pos", value: str = "value"):
    """``keep`` with ``posexplode(array)``, the array computed once a row.

    An inner explode gets a filter on the array's size, which the optimizer pushes down
    with all that computes the array, many times over where later steps use earlier ones
    more than once.  The outer form has none; rows without elements go afterwards.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def linspace(a, b, n) -> Column:
    """G1: n evenly spaced points from a to b, both ends included.

    Point i is a + i*step with the last point set to b exactly (NumPy's
    definition); n = 1 gives [a].
    """
    a, b, n = _lit(a).cast("double"), _lit(b).cast("double"), _lit(n).cast("int")
    step = (b - a) / (n - 1).cast("double")
    return F.when(n <= 0, F.array().cast("array<double>")).when(
        n == 1, F.array(a)).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1),
                    lambda i: F.when(i == n - 1, b).otherwise(i.cast("double") * step + a)))


def logspace(a, b, n) -> Column:
    """10 ** linspace(log10 a, log10 b, n)."""
    return F.transform(linspace(F.log10(_lit(a)), F.log10(_lit(b)), n),
                       lambda e: F.pow(F.lit(10.0), e))


def grid_cents(x) -> Column:
    """Grid price in cents: x*100 is first rounded to six places, then half to even.

    A log-spaced end that lies on a half cent is off by an ulp either way,
    depending on the host's log and pow; the snap takes that noise away, so
    every host and engine gives the same price.
    """
    return F.rint(F.rint(_lit(x) * 1e8) / 1e6) / 100.0


def unique_sorted(arr: Column) -> Column:
    """U4: distinct values, ascending (in the values' own order: no comparison per pair is interpreted)."""
    return F.sort_array(F.array_distinct(arr))


def price_bounds(status, customer_price, winner_price, min_price) -> Column:
    """struct(lo, hi, mid) of the search range.

    win:                lo = max(w, min), hi = w + 10 %
    lose, c > w:        lo = max(w, min), hi = min(c, w + 10 %)
    lose, c <= w:       lo = max(c - 10 %, min), hi = w
    mid is the winner price in every case.
    """
    s, c, w, m = _lit(status), _lit(customer_price), _lit(winner_price), _lit(min_price)
    w_up = w + w * SPREAD
    c_down = c - c * SPREAD
    lo = F.when(s == 1, F.greatest(w, m)).when(c > w, F.greatest(w, m)) \
          .otherwise(F.greatest(c_down, m))
    hi = F.when(s == 1, w_up).when(c > w, F.least(c, w_up)).otherwise(w)
    return F.struct(lo.alias("lo"), hi.alias("hi"), w.alias("mid"))


def grid_from_base(lo, mid, hi, base, pivot) -> Column:
    """G5 from the branch's distinct prices and the smallest of them (see ``with_price_grid``)."""
    lo, mid, hi = _lit(lo), _lit(mid), _lit(hi)
    mirror = F.transform(F.filter(base, lambda e: ((pivot - (e - pivot)) >= lo) & (e != lo)),
                         lambda e: pivot - (e - pivot))
    return F.when((lo == mid) | (mid == hi), base).otherwise(unique_sorted(F.concat(mirror, base)))


def with_price_grid(df, lo: str = "lo", mid: str = "mid", hi: str = "hi", out: str = "grid",
                    only: Column | bool = True):
    """Candidate prices, rounded to cents, distinct and sorted; null where
    ``only`` does not hold.

    lo = mid: 80 log-spaced points from mid to hi.
    mid = hi: 50 log-spaced points from lo to hi.
    otherwise: 50 log-spaced points from mid to hi plus their mirror
    images below the smallest of them, kept while >= lo.
    One log-spaced array per row (G2 between the branch's ends), then
    rounding (``grid_cents``), distinct, mirror and sort, all as JVM expressions.
    """
    lo_c, mid_c, hi_c = F.col(lo), F.col(mid), F.col(hi)
    start = F.when(lo_c == mid_c, mid_c).when(mid_c == hi_c, lo_c).otherwise(mid_c)
    n = F.when(lo_c == mid_c, F.lit(POINTS_UP_ONLY)).otherwise(F.lit(POINTS_DEFAULT))
    a, b = F.log10(start), F.log10(hi_c)
    ends = F.struct(a.alias("a"), b.alias("b"), (n - 1).alias("last"), ((b - a) / (n - 1).cast("double")).alias("step"))
    cents = once(ends, lambda e: F.transform(F.sequence(F.lit(0), e["last"]), lambda i: grid_cents(F.pow(
        F.lit(10.0), F.when(i == e["last"], e["b"]).otherwise(i.cast("double") * e["step"] + e["a"])))))
    base = df.withColumn("_base", F.when(_lit(only), unique_sorted(cents)))
    base = base.withColumn("_pivot", F.array_min("_base"))
    grid = F.when(_lit(only), grid_from_base(lo_c, mid_c, hi_c, F.col("_base"), F.col("_pivot")))
    return base.withColumn(out, grid).drop("_base", "_pivot")


def split_range(lo, hi, current, steps, state) -> Column:
    """Linspace between a bound and the current price.

    state -1 (lose): between lo and current; state 1 (win): between current
    and hi; always from the smaller to the larger end.
    """
    lo, hi, cur, s = _lit(lo), _lit(hi), _lit(current), _lit(state)
    lose = F.when(lo < cur, linspace(lo, cur, steps)).otherwise(linspace(cur, lo, steps))
    win = F.when(hi > cur, linspace(cur, hi, steps)).otherwise(linspace(hi, cur, steps))
    return F.when(s == -1, lose).when(s == 1, win)


def array_median(arr: Column) -> Column:
    """Median of a numeric array (mean of the two middle values if even)."""
    return _middle(F.sort_array(arr))


def _middle(srt: Column) -> Column:
    """Median of a sorted array."""
    n = F.size(srt)
    lo = F.element_at(srt, ((n - 1) / 2).cast("int") + 1)
    hi = F.element_at(srt, (n / 2).cast("int") + 1)
    return (lo + hi) / 2.0


def _clip_all(arr: Column, lo: Column, hi: Column) -> Column:
    return F.transform(arr, lambda x: F.least(F.greatest(x, lo), hi))


def limit_prices(prices, current, state) -> Column:
    """Clip a sorted price list around the customer's price.

    lose: min < c -> clip [min, c]; min = c -> clip [c, median];
          min > c -> split_range between c and min.
    win:  max > c -> clip [c, max]; max = c -> clip [median, c];
          max < c -> split_range between max and c.
    """
    arr = F.sort_array(_lit(prices))
    return _limited(arr, F.array_min(arr), F.array_max(arr), array_median(arr), _lit(current), _lit(state))


def _limited(arr: Column, mn: Column, mx: Column, med: Column, c: Column, s: Column) -> Column:
    n = F.size(arr)
    lose = (F.when(mn < c, _clip_all(arr, mn, c))
             .when(mn == c, _clip_all(arr, c, med))
             .otherwise(split_range(c, mn, c, n, F.lit(-1))))
    win = (F.when(mx > c, _clip_all(arr, c, mx))
            .when(mx == c, _clip_all(arr, med, c))
            .otherwise(split_range(mx, c, c, n, F.lit(1))))
    return F.when(s == -1, lose).when(s == 1, win).otherwise(arr)


def with_limited_prices(df, prices: str, current: str, state: str, out: str = "limited"):
    """G7 as a column ``out``; the sorted list, its ends and its median are computed once a row
    (``limit_prices`` is one expression that holds them many times)."""
    rows = df.withColumn("_la", F.sort_array(prices))
    rows = rows.withColumns({"_lmn": F.array_min("_la"), "_lmx": F.array_max("_la"), "_lmd": _middle(F.col("_la"))})
    fixed = F.struct(*[F.col(x).alias(n) for x, n in (("_lmn", "mn"), ("_lmx", "mx"), ("_lmd", "med"), (current, "c"), (state, "s"))])
    limited = once(fixed, lambda e: _limited(F.col("_la"), e["mn"], e["mx"], e["med"], e["c"], e["s"]))
    return rows.withColumn(out, limited).drop("_la", "_lmn", "_lmx", "_lmd")


def nearest(items, pivot) -> Column:
    """Element closest to ``pivot``; the first one wins ties."""
    p = _lit(pivot)
    tagged = F.transform(_lit(items), lambda x, i: F.struct(
        F.abs(x - p).alias("d"), i.alias("i"), x.alias("x")))
    return F.array_min(tagged)["x"]
