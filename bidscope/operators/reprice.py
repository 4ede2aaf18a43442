"""Repricing: candidate prices for every auction at once, scored and
smoothed, best price recommended, then back-tested (R2-R10, G3, J4, J7,
K1, K2).

Shuffle plan: the product history minimum is an aggregate joined on
ProductId while rows are narrow; one exchange by auction after it serves
the gate, the winner price, the bounds, the grid and the scores (bounded
per-auction windows).  Candidates (<= 80 per auction) stay an array on
the customer row (``pack_candidates``) through scores, curve and
recommendation, so no candidate row is shuffled, sorted or buffered;
``unpack`` and ``make_candidates`` make rows by one lateral ``explode``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.grid import exploded, once, price_bounds, with_price_grid
from bidscope.functions.scalars import (clip, normal_weight, price_direction, round2,
                                        ship_hours_floor)
from bidscope.operators.features import minmax
from bidscope.operators.groups import minmax_expr, with_group_stats
from bidscope.operators.scoring import new_score_expr
from bidscope.schema import (AUCTION, CUSTOMER, DIFF_MIN_PRODUCT, FBA, FEATURED, IDEAL_POINT, LANDED,
                             LISTING, MAX_HOURS, PRODUCT, SHIPPING, WINNER)

TOP_N = 10          # fixed value: rows shown in the recommendation table
POLY_DEGREE = 5     # fixed value: degree of the score curve


def _landed() -> Column:
    return F.col(LISTING) + F.col(SHIPPING)


def winner_price(offers: DataFrame, group: str = AUCTION) -> DataFrame:
    """G3 per auction: (n_winners, WinnerPrice, NoWinner, WinnerHours,
    MinPrice).

    No winner: the auction minimum (flagged); one or many winners: the
    minimum landed price among winners.  WinnerHours = least max-hours
    among offers at that price.
    """
    df = offers.select(group, WINNER, MAX_HOURS, _landed().alias("_l"))
    df = with_group_stats(df, group, {
        "n_winners": F.sum((F.col(WINNER) == 1).cast("long")),
        "MinPrice": F.min("_l"),
        "_wmin": F.min(F.when(F.col(WINNER) == 1, F.col("_l")))})
    df = df.withColumn("WinnerPrice", F.coalesce("_wmin", "MinPrice"))
    df = with_group_stats(df, group, {
        "WinnerHours": F.min(F.when(F.col("_l") == F.col("WinnerPrice"), F.col(MAX_HOURS)))})
    return (df.groupBy(group).agg(
        F.first("n_winners").alias("n_winners"), F.first("WinnerPrice").alias("WinnerPrice"),
        (F.first("n_winners") == 0).alias("NoWinner"), F.first("WinnerHours").alias("WinnerHours"),
        F.first("MinPrice").alias("MinPrice")))


def product_history_min(history: DataFrame) -> DataFrame:
    """J4 part 1: min landed price per product over the history table
    (not filtered by market, as in the original)."""
    return history.groupBy(PRODUCT).agg(F.min(_landed()).alias("ProductMinPrice"))


def auction_context(offers: DataFrame, group: str = AUCTION) -> DataFrame:
    """Per-auction columns on every offer row: CustomerPrice, CustomerStatus,
    WinnerPrice, MinPrice, n_winners, n_customers and bounds (lo, hi, mid).

    All statistics are windows of one auction key -> one exchange.
    """
    df = offers.withColumn(LANDED, _landed())
    df = with_group_stats(df, group, {
        "n_winners": F.sum((F.col(WINNER) == 1).cast("long")),
        "MinPrice": F.min(LANDED),
        "MaxPrice": F.max(LANDED),
        "_wmin": F.min(F.when(F.col(WINNER) == 1, F.col(LANDED))),
        "n_customers": F.sum((F.col(CUSTOMER) == 1).cast("long")),
        "CustomerPrice": F.max(F.when(F.col(CUSTOMER) == 1, F.col(LANDED))),
        "CustomerStatus": F.max(F.when(F.col(CUSTOMER) == 1, F.col(WINNER)))})
    df = df.withColumn("WinnerPrice", F.coalesce("_wmin", "MinPrice")).drop("_wmin")
    b = price_bounds(F.col("CustomerStatus"), F.col("CustomerPrice"), F.col("WinnerPrice"),
                     F.col("MinPrice"))
    return df.withColumn("_b", b).select(
        "*", F.col("_b.lo").alias("lo"), F.col("_b.hi").alias("hi"),
        F.col("_b.mid").alias("mid")).drop("_b")


#: Array of the customer row's candidate prices, of all candidates' (Price, Score), and of their (Price, Score, Smoothed).
GRID, SCORED, CURVE = "_grid", "_scored", "_curve"


def pack_candidates(offers: DataFrame, history: DataFrame | None = None, group: str = AUCTION,
                    minima: DataFrame | None = None) -> DataFrame:
    """R2 before J7: F6 -> G3 -> G4 -> G5 -> J4 with the candidates as an array of prices.

    One row per real offer of the gated auctions; the customer row has its grid in
    ``GRID`` (null elsewhere).  ``minima`` is ``product_history_min`` where it is known.
    """
    hist = minima if minima is not None else product_history_min(history if history is not None else offers)
    # joined first: the exchange to the auctions comes after it and serves all windows
    ctx = auction_context(offers.join(hist, on=PRODUCT, how="left"), group).where(F.col("n_customers") == 1).drop("n_customers")
    ctx = ctx.withColumn("ProductMinPrice", F.coalesce("ProductMinPrice", "MinPrice"))
    return with_price_grid(ctx, out=GRID, only=F.col(CUSTOMER) == 1)


def unpack(packed: DataFrame) -> DataFrame:
    """J7 + U1: the real offers and one copy of the customer row per candidate (LandedPrice = its
    price), flagged by ``is_candidate``, with their scores once there are any.

    Every row carries an array of prices: its own, and on the customer row the
    candidates as well; one ``explode`` makes the rows.
    """
    scored = SCORED in packed.columns

    def row(price, score, candidate):
        found = [score.alias("s")] if scored else []
        return F.struct(price.alias("x"), F.lit(candidate).alias("c"), *found)

    own = F.array(row(F.col(LANDED), F.col("Score") if scored else None, False))
    if scored:
        others = F.transform(SCORED, lambda e: row(e["Price"], e["Score"], True))
    else:
        others = F.transform(GRID, lambda x: row(x, None, True))
    keep = [c for c in packed.columns if c not in (LANDED, GRID, SCORED, "Score")]
    rows = packed.withColumn("_all", F.when(others.isNull(), own).otherwise(F.concat(own, others)))
    out = exploded(rows, "_all", keep, "_i", "_p").select(
                      *keep,
                      F.col("_p.x").alias(LANDED), F.col("_p.c").alias("is_candidate"),
                      *([F.col("_p.s").alias("Score")] if scored else []))
    return out.withColumn(DIFF_MIN_PRODUCT, F.col(LANDED) - F.col("ProductMinPrice"))


def make_candidates(offers: DataFrame, history: DataFrame | None = None,
                    group: str = AUCTION) -> DataFrame:
    """R2: F6 -> G3 -> G4 -> G5 -> J4 -> J7 -> U1.

    Returns every real offer of the gated auctions plus one candidate row
    per grid price (a copy of the customer row with LandedPrice = price),
    flagged by ``is_candidate``; DifftoMinLandedPriceProduct is landed
    minus the product's history minimum (auction minimum if unseen).
    """
    return unpack(pack_candidates(offers, history, group))


def _ends(df: DataFrame, keys: Sequence[str], own: str, others: str, lo: str, hi: str) -> dict[str, Column]:
    """Aggregates of the least and greatest of a column and of the arrays ``others``."""
    return {lo: F.min(F.least(own, F.array_min(others))), hi: F.max(F.greatest(own, F.array_max(others)))}


def _scaled(array: Column | str, lo: str, hi: str, use=lambda y: y) -> Column:
    """``use`` of ``minmax_expr`` of every element (constant -> 1)."""
    span = F.struct(F.col(lo).alias("lo"), (F.col(hi) - F.col(lo)).alias("span"))
    return (F.when(F.col(hi) == F.col(lo), F.transform(array, lambda x: use(F.lit(1.0))))
            .otherwise(once(span, lambda e: F.transform(array, lambda x: use((x - e["lo"]) / e["span"])))))


def _score_packed(packed: DataFrame, p: Column, keys: Sequence[str]) -> DataFrame:
    """``score_candidates`` of packed rows: the windows see the real offers only, each with the ends of
    its candidates' values; the candidates' own values are arrays, in the same arithmetic."""
    keys = list(keys)
    df = packed.withColumns({"_h": ship_hours_floor(MAX_HOURS), "_p": p.cast("double")})
    df = df.withColumns({"_x": F.col(LANDED) * F.col("_h"), "_wt": normal_weight(LANDED, "WinnerPrice"),
                         "_gx": once(F.col("_h"), lambda h: F.transform(GRID, lambda x: x * h)),
                         "_gw": once(F.col("WinnerPrice"), lambda m: F.transform(GRID, lambda x: normal_weight(x, m)))})
    df = with_group_stats(df, keys, {"_ml": F.min(F.least(LANDED, F.array_min(GRID))), "_mh": F.min("_h"),
                                     **_ends(df, keys, "_x", "_gx", "_xlo", "_xhi"), **_ends(df, keys, "_wt", "_gw", "_wlo", "_whi")})
    c = F.col("_ml") * F.col("_mh")
    # as in the row form: c - x is monotone, so its ends are those of x
    df = df.withColumns({"_x": c - F.col("_x"), "_ilo": c - F.col("_xhi"), "_ihi": c - F.col("_xlo"),
                         "_gx": once(c, lambda v: F.transform("_gx", lambda x: v - x))}).drop("_ml", "_mh", "_xlo", "_xhi")
    df = df.withColumns({IDEAL_POINT: minmax_expr(F.col("_x"), F.col("_ilo"), F.col("_ihi")), "_gx": _scaled("_gx", "_ilo", "_ihi")})
    terms = F.struct((F.col(FBA) * F.col("_p")).alias("fba"), F.col("_p").alias("p"), (F.col("_p") * F.col(FEATURED)).alias("featured"))
    df = df.withColumns({"NewScore": new_score_expr(F.col("_p")),                       # M5, term by term in both
                         "_gn": once(terms, lambda e: F.transform("_gx", lambda i: e["fba"] + e["p"] * i + e["featured"]))})
    df = df.withColumns({"_wt": minmax_expr(F.col("_wt"), F.col("_wlo"), F.col("_whi")), "_gw": _scaled("_gw", "_wlo", "_whi")})
    df = df.drop("_h", "_x", "_gx", "_ilo", "_ihi", "_wlo", "_whi", "_p")
    df = with_group_stats(df, keys, _ends(df, keys, "NewScore", "_gn", "_nlo", "_nhi"))
    df = df.withColumns({"_bl": minmax_expr(F.col("NewScore"), F.col("_nlo"), F.col("_nhi")) + F.col("_wt"),
                         "_gb": F.zip_with(_scaled("_gn", "_nlo", "_nhi"), "_gw", lambda n, w: n + w)}).drop("_gn", "_gw", "_wt", "_nlo", "_nhi")
    df = with_group_stats(df, keys, _ends(df, keys, "_bl", "_gb", "_blo", "_bhi"))
    df = df.withColumns({"Score": minmax_expr(F.col("_bl"), F.col("_blo"), F.col("_bhi")) * 100.0,
                         SCORED: F.zip_with(GRID, _scaled("_gb", "_blo", "_bhi", lambda y: y * 100.0),
                                            lambda x, y: F.struct(x.alias("Price"), y.alias("Score")))})
    return df.drop("_bl", "_gb", "_blo", "_bhi")


def _same_for_candidates(packed: DataFrame, p: Column) -> bool:
    """True where a probability needs no column in which a candidate differs from its offer."""
    try:
        packed.drop(LANDED, DIFF_MIN_PRODUCT, "is_candidate").select(p)
    except AnalysisException:
        return False
    return True


def score_candidates(frame: DataFrame, prob: Column | str | float = 0.5,
                     keys: Sequence[str] = (AUCTION,)) -> DataFrame:
    """FP2 features on real offers + candidates together, M5, blend.

    ideal point (P9 first) over ALL rows of the auction incl. candidates,
    W6 by auction; NewScore = M5(prob); Score = 100 * minmax(minmax(NewScore)
    + minmax(N(WinnerPrice, 1) density at LandedPrice)), per auction.

    A packed frame (``pack_candidates``) stays packed, with ``Score`` and the
    candidates' (Price, Score) in ``SCORED``; where ``prob`` depends on the price it is
    unpacked first.
    """
    keys = list(keys)
    p = prob if isinstance(prob, Column) else (F.col(prob) if isinstance(prob, str)
                                               else F.lit(float(prob)))
    if GRID in frame.columns:
        if _same_for_candidates(frame, p):
            return _score_packed(frame, p, keys)
        frame = unpack(frame)
    df = frame.withColumn("_h", ship_hours_floor(MAX_HOURS)) \
              .withColumn("_x", F.col(LANDED) * F.col("_h")) \
              .withColumn("_wt", normal_weight(LANDED, "WinnerPrice"))
    # pass 1: ideal point = c - x with c = min(L)*min(H); subtracting from a
    # constant is monotone in IEEE arithmetic, so its group min / max are
    # c - max(x) / c - min(x) exactly and need no second pass; the weight
    # depends on the row only, so its min / max come from the same pass
    df = with_group_stats(df, keys, {"_ml": F.min(LANDED), "_mh": F.min("_h"),
                                     "_xhi": F.max("_x"), "_xlo": F.min("_x"),
                                     "_wlo": F.min("_wt"), "_whi": F.max("_wt")})
    c = F.col("_ml") * F.col("_mh")
    ideal = c - F.col("_x")
    df = df.withColumn(IDEAL_POINT, minmax_expr(ideal, c - F.col("_xhi"), c - F.col("_xlo")))
    df = df.withColumn("NewScore", new_score_expr(p))
    df = df.withColumn("_wt_n", minmax_expr(F.col("_wt"), F.col("_wlo"), F.col("_whi")))
    # pass 2: NewScore range; pass 3: blend range
    df = minmax(df, keys, ["NewScore"], suffix="_n")
    df = df.withColumn("_blend", F.col("NewScore_n") + F.col("_wt_n"))
    df = with_group_stats(df, keys, {"_blo": F.min("_blend"), "_bhi": F.max("_blend")})
    score = minmax_expr(F.col("_blend"), F.col("_blo"), F.col("_bhi")) * 100.0
    return df.withColumn("Score", score).drop(
        "_h", "_x", "_wt", "_ml", "_mh", "_xhi", "_xlo", "_wlo", "_whi", "NewScore_n", "_wt_n",
        "_blend", "_blo", "_bhi")


def _stacked_fits(degree: int):
    """(x, y, sizes of the groups, one after the other) -> the polyfit of each group at its points."""
    def fitted(xs, ys, size):       # nested: travels with the task
        first, res = np.cumsum(size) - size, np.empty(len(xs))
        for n in np.unique(size[size > 0]):
            at = first[size == n][:, None] + np.arange(n)[None, :]
            van = xs[at][:, :, None] ** np.arange(degree, -1, -1)
            scale = np.sqrt((van * van).sum(axis=1, keepdims=True))
            scaled = van / np.where(scale > 0, scale, 1)
            coef = np.linalg.pinv(scaled, rcond=n * np.finfo(float).eps) @ ys[at][:, :, None]
            res[at] = (scaled @ coef)[:, :, 0]
        return res

    return fitted


def poly_smooth(df: DataFrame, keys: Sequence[str], x: str, y: str,
                degree: int = POLY_DEGREE, out: str = "Smoothed",
                carry: Sequence[str] = ()) -> DataFrame:
    """R4 core: least-squares polynomial of ``y`` on ``x`` per group,
    evaluated at each row (column-scaled SVD, minimum norm, as NumPy's
    polyfit).  ``carry`` columns pass through.

    Rows are clustered by key (one exchange) and streamed through
    ``mapInPandas`` as Arrow batches; a group cut by a batch boundary is
    carried into the next batch, so each group is fitted whole and no
    group is ever materialised beyond its own rows (<= 80 candidates).
    The groups of a batch with equally many rows are fitted by one
    stacked pseudo-inverse.
    """
    keys, cols = list(keys), [*keys, x, y, *carry]
    src = df.select(*cols).repartition(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([*[src.schema[c] for c in cols], T.StructField(out, T.DoubleType())])
    fitted = _stacked_fits(degree)

    def fit(pdf):       # nested: travels with the task
        group = pdf.groupby(keys, sort=False).ngroup().to_numpy()
        order = np.argsort(group, kind="stable")
        xs, ys = (pdf[c].to_numpy(dtype=float)[order] for c in (x, y))
        res = np.empty(len(pdf))
        res[order] = fitted(xs, ys, np.bincount(group))
        return pdf.assign(**{out: res})

    def run(batches):
        left = None
        for pdf in batches:
            if left is not None and len(left):
                pdf = pd.concat([left, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf.iloc[-1][keys]
            tail = (pdf[keys] == last.values).all(axis=1)
            left, done = pdf[tail], pdf[~tail].reset_index(drop=True)
            if len(done):
                yield fit(done)
        if left is not None and len(left):
            yield fit(left.reset_index(drop=True))

    return src.mapInPandas(run, schema)


def orthogonal_smooth(df: DataFrame, keys: Sequence[str], x: str, y: str, degree: int = POLY_DEGREE,
                      out: str = "Smoothed", carry: Sequence[str] = ()) -> DataFrame:
    """R4 core as JVM expressions: least squares by polynomials that are orthogonal over
    each group's points.

    With t = x scaled to [-1, 1]: p0 = 1, p(k+1) = (t - a(k)) p(k) - b(k) p(k-1), where
    a(k) = sum(t p(k)^2) / sum(p(k)^2) and b(k) = sum(p(k)^2) / sum(p(k-1)^2); the fit is
    the sum of p(k) sum(y p(k)) / sum(p(k)^2).  Each degree is one pass of windows over
    the same key, so there is one exchange, and none where the rows come partitioned by
    it.  A degree that vanishes at all points (fewer different x than coefficients)
    adds nothing.

    The system is well conditioned for every price range, where ``poly_smooth`` follows
    NumPy's ``polyfit``: that one drops directions of the plain powers below its
    tolerance, which happens where prices differ by about a hundredth of their size.
    """
    keys, cols = list(keys), [*keys, x, y, *carry]

    def over(frame, aggs):
        return with_group_stats(frame, keys, aggs, "window")

    zero = F.lit(0.0)
    fit = over(df.select(*cols), {"_lo": F.min(x), "_hi": F.max(x), "_pp": F.sum(F.lit(1.0)), "_fit": F.avg(y)})
    t = (F.lit(2.0) * F.col(x) - F.col("_lo") - F.col("_hi")) / (F.col("_hi") - F.col("_lo"))
    fit = fit.withColumn("_t", F.when(F.col("_hi") > F.col("_lo"), t).otherwise(zero)).withColumn("_least", F.lit(1e-20) * F.col("_pp"))
    fit = over(fit.drop("_lo", "_hi"), {"_tp": F.sum("_t")}).withColumns({"_p": F.lit(1.0), "_q": zero, "_qq": F.lit(1.0)})
    for k in range(degree):
        some = F.col("_pp") > F.col("_least")
        step = (F.col("_t") - F.col("_tp") / F.col("_pp")) * F.col("_p")
        if k:
            step = step - F.col("_pp") / F.col("_qq") * F.col("_q")
        fit = fit.withColumn("_new", F.when(some, step).otherwise(zero))
        fit = over(fit, {"_nn": F.sum(F.col("_new") * F.col("_new")), "_yn": F.sum(F.col(y) * F.col("_new")),
                         "_tn": F.sum(F.col("_t") * F.col("_new") * F.col("_new"))})
        add = F.when(F.col("_nn") > F.col("_least"), F.col("_new") * F.col("_yn") / F.col("_nn")).otherwise(zero)
        fit = fit.select(*cols, "_t", "_least", (F.col("_fit") + add).alias("_fit"), F.col("_new").alias("_p"), F.col("_p").alias("_q"),
                         F.col("_nn").alias("_pp"), F.col("_pp").alias("_qq"), F.col("_tn").alias("_tp"))
    return fit.select(*cols, F.col("_fit").alias(out))


def linear_smooth(df: DataFrame, keys: Sequence[str], x: str, y: str,
                  out: str = "Smoothed", carry: Sequence[str] = ()) -> DataFrame:
    """R4 with degree 1: regr_slope / regr_intercept per group (SQL-expressible)."""
    keys = list(keys)
    fit = with_group_stats(df.select(*keys, x, y, *carry), keys, {
        "_b1": F.regr_slope(y, x), "_b0": F.regr_intercept(y, x)})
    b1 = F.coalesce("_b1", F.lit(0.0))
    b0 = F.coalesce("_b0", F.col(y))
    return fit.withColumn(out, b1 * F.col(x) + b0).drop("_b1", "_b0")


def _poly_packed(df: DataFrame, degree: int) -> DataFrame:
    """``poly_smooth`` of arrays: the curves of an Arrow batch are fitted in stacks, nothing is shuffled."""
    import pyarrow as pa
    fitted, most = _stacked_fits(degree), 512       # curves fitted at once
    item = T.ArrayType(T.DoubleType())

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                xs, ys = batch.column("_xs"), batch.column("_ys")
                size = np.diff(xs.offsets.to_numpy())
                x, y = (c.flatten().to_numpy(zero_copy_only=False).astype(float) for c in (xs, ys))
                res = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(fitted(x, y, size)))
                yield pa.RecordBatch.from_arrays([*batch.columns, res], names=[*batch.schema.names, "_fit"])

    src = df.withColumns({"_xs": F.col(f"{SCORED}.Price"), "_ys": F.col(f"{SCORED}.Score")}).drop(SCORED)
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("_fit", item)]))


def _linear_packed(df: DataFrame) -> DataFrame:
    """``linear_smooth`` of arrays: means, then the sums of centred products."""
    zero = F.lit(0.0)

    def line(v):
        covered = F.aggregate(SCORED, zero, lambda a, e: a + (e["Price"] - v["x"]) * (e["Score"] - v["y"]))
        spread = F.aggregate("_xs", zero, lambda a, x: a + (x - v["x"]) * (x - v["x"]))
        return F.struct(covered.alias("c"), spread.alias("m"), v["x"].alias("x"), v["y"].alias("y"))

    def ends(v):
        slope = F.when(v["m"] != 0, v["c"] / v["m"])
        return F.struct(F.coalesce(slope, zero).alias("b1"), (v["y"] - slope * v["x"]).alias("b0"))

    fit = df.withColumns({"_xs": F.col(f"{SCORED}.Price"), "_ys": F.col(f"{SCORED}.Score")})
    total = lambda c: F.aggregate(c, zero, lambda a, x: a + x) / F.size(c)      # noqa: E731
    means = F.struct(total("_xs").alias("x"), total("_ys").alias("y"))
    fitted = once(once(once(means, line), ends), lambda v: F.transform(SCORED, lambda e: v["b1"] * e["Price"] + F.coalesce(v["b0"], e["Score"])))
    return fit.withColumn("_fit", fitted).drop(SCORED)


#: Columns of the auction that a recommendation reports.
CONTEXT = ("CustomerPrice", "WinnerPrice", "CustomerStatus")


def pack_curve(scored: DataFrame, keys: Sequence[str] = (AUCTION,), degree: int = POLY_DEGREE,
               carry: Sequence[str] = ()) -> DataFrame:
    """R4 of packed scores: keys, ``carry`` and the curve as an array of (Price, Score, Smoothed), one row a key."""
    cand = scored.where(F.col(CUSTOMER) == 1).select(*keys, *carry, SCORED)
    fit = _linear_packed(cand) if degree == 1 else _poly_packed(cand, degree)
    clipped = F.transform("_fit", lambda f: clip(f, 0.0, 100.0))
    point = F.arrays_zip(F.col("_xs").alias("Price"), F.col("_ys").alias("Score"), clipped.alias("Smoothed"))
    return fit.select(*keys, *carry, point.alias(CURVE))


def smooth_curve(scored: DataFrame, keys: Sequence[str] = (AUCTION,),
                 degree: int = POLY_DEGREE, carry: Sequence[str] = (), orthogonal: bool = False) -> DataFrame:
    """Fit Score on price over the candidates, evaluate, clip to 0..100.

    Output: keys, Price (= candidate LandedPrice), Score, ``carry``, Smoothed.
    ``orthogonal`` fits by orthogonal polynomials instead of NumPy's ``polyfit``.
    Packed scores are fitted as arrays (``pack_curve``) and unpacked at the end; for the
    orthogonal form they are unpacked first, as narrow rows that are still dealt by auction.
    """
    if SCORED in scored.columns and not orthogonal:
        points = exploded(pack_curve(scored, keys, degree, carry), CURVE, [*keys, *carry], "_i", "_e")
        return points.select(*keys, F.col("_e.Price").alias("Price"), F.col("_e.Score").alias("Score"), *carry,
                             F.col("_e.Smoothed").alias("Smoothed"))
    if SCORED in scored.columns:
        rows = exploded(scored.where(F.col(CUSTOMER) == 1), SCORED, [*keys, *carry], "_i", "_e")
        cand = rows.select(*keys, F.col("_e.Price").alias("Price"), F.col("_e.Score").alias("Score"), *carry)
    else:
        cand = scored.where("is_candidate").select(*keys, F.col(LANDED).alias("Price"), "Score", *carry)
    if orthogonal:
        fit = orthogonal_smooth(cand, keys, "Price", "Score", degree, carry=carry)
    else:
        fit = (linear_smooth(cand, keys, "Price", "Score", carry=carry) if degree == 1
               else poly_smooth(cand, keys, "Price", "Score", degree, carry=carry))
    return fit.withColumn("Smoothed", clip("Smoothed", 0.0, 100.0))


def _top_packed(curves: DataFrame, keys: Sequence[str], top_n: int) -> DataFrame:
    """The first rows of each curve: an array is ordered instead of a window."""
    rows = F.transform(CURVE, lambda e: F.struct((-round2(e["Smoothed"])).alias("s"), round2(e["Price"]).alias("x")))
    first = F.array(F.array_min("_rows")) if top_n == 1 else F.slice(F.sort_array("_rows"), 1, top_n)
    rows = exploded(curves.withColumn("_rows", rows).withColumn("_first", first), "_first", [*keys, *CONTEXT], "_i", "_e")
    return rows.select(*keys, F.col("_e.x").alias("Price"), (-F.col("_e.s")).alias("PredictedScore"), *CONTEXT,
                       price_direction(F.col("_e.x"), "CustomerPrice").alias("Direction"), (F.col("_i") + 1).alias("rank"))


def recommend(smoothed: DataFrame, keys: Sequence[str] = (AUCTION,),
              top_n: int = TOP_N) -> tuple[DataFrame, DataFrame]:
    """R5 + K1 + K2: (top-n table, one recommendation per key).

    Price rounded to cents, PredictedScore to 2 decimals, Direction vs the
    customer price at 3 decimals; top rows by score desc, price asc
    (deterministic tie order); RecommendedPrice = price of the first row.
    ``smoothed`` is R4 with the ``CONTEXT`` columns carried along, as rows or packed
    (``pack_curve``).
    """
    keys = list(keys)
    if CURVE in smoothed.columns:
        top, first = _top_packed(smoothed, keys, top_n), _top_packed(smoothed, keys, 1)
    else:
        t = (smoothed.select(*keys, round2("Price").alias("Price"),
                             round2("Smoothed").alias("PredictedScore"), *CONTEXT)
                     .withColumn("Direction", price_direction("Price", "CustomerPrice")))
        w = Window.partitionBy(*keys).orderBy(F.col("PredictedScore").desc(), F.col("Price").asc())
        top = t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
        first = top.where(F.col("rank") == 1)
    rec = first.select(*keys, F.col(AUCTION).alias("File"), *CONTEXT,
                       F.col("Price").alias("RecommendedPrice"), "PredictedScore", "Direction")
    return top, rec


def auction_scores(scored: DataFrame, keys: Sequence[str] = (AUCTION,)) -> DataFrame:
    """Scores of the real offers: winners (0 if none; min/max/list if
    many), the customer's, and the competitors' (list)."""
    keys = list(keys)
    real = scored if SCORED in scored.columns else scored.where(~F.col("is_candidate"))
    s = F.col("Score")
    return real.groupBy(*keys).agg(
        F.sum((F.col(WINNER) == 1).cast("long")).alias("n_winners"),
        F.coalesce(F.min(F.when(F.col(WINNER) == 1, s)), F.lit(0.0)).alias("WinnerScoreMin"),
        F.coalesce(F.max(F.when(F.col(WINNER) == 1, s)), F.lit(0.0)).alias("WinnerScoreMax"),
        F.array_sort(F.collect_list(F.when(F.col(WINNER) == 1, s))).alias("WinnerScores"),
        F.max(F.when(F.col(CUSTOMER) == 1, s)).alias("CustomerScore"),
        F.array_sort(F.collect_list(F.when(F.col(CUSTOMER) != 1, s))).alias("CompetitorScores"))


def reprice(offers: DataFrame, history: DataFrame | None = None,
            prob: Column | str | float = 0.5, degree: int = POLY_DEGREE, minima: DataFrame | None = None) -> DataFrame:
    """R2 -> R3 -> R4 -> R5 for every gated auction: one recommendation per
    auction (File, CustomerPrice, WinnerPrice, RecommendedPrice, ...).
    ``minima`` is ``product_history_min`` of the history where it is known."""
    scored = score_candidates(pack_candidates(offers, history, minima=minima), prob)
    curve = pack_curve if SCORED in scored.columns else smooth_curve
    _, rec = recommend(curve(scored, (AUCTION,), degree, CONTEXT))
    return rec


def backtest(results: DataFrame, recommended: Sequence[str]) -> DataFrame:
    """gap = recommended - NextPrice per classifier column, both
    rounded to cents first (long form: File, clf, gap)."""
    parts = [F.struct(F.lit(c).alias("clf"),
                      (round2(F.col(c)) - round2(F.col("NextPrice"))).alias("gap"))
             for c in recommended]
    keep = [c for c in ("File", "NextFile", "CustomerStatus") if c in results.columns]
    return (results.select(*keep, F.explode(F.array(*parts)).alias("r"))
                   .select(*keep, "r.clf", "r.gap"))


def split_by_gap(gaps: DataFrame) -> DataFrame:
    """Lost auctions whose recommendation overshot (gap > 0,
    'greater') or undershot (gap < 0, 'smaller') the next winning price."""
    lost = gaps.where(F.col("CustomerStatus") != 1)
    return lost.where(F.col("gap") != 0).withColumn(
        "side", F.when(F.col("gap") > 0, "greater").otherwise("smaller"))


def compare_classifiers(gaps: DataFrame, a: str, b: str) -> DataFrame:
    """Two recommenders side by side per event, with the gap difference."""
    keys = [c for c in ("File", "NextFile") if c in gaps.columns]
    wide = gaps.groupBy(*keys).pivot("clf", [a, b]).agg(F.first("gap"))
    return wide.withColumn("gap_diff", F.col(a) - F.col(b))
