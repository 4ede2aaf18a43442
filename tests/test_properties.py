"""Properties on the sf0.001 auction view (SURVEY §5 (3))."""

import pytest
from pyspark.sql import functions as F

from bidscope.functions.scalars import landed_price
from bidscope.operators import features as W
from bidscope.operators import reprice as RP
from bidscope.operators.ranking import global_rank, quantiles
from bidscope.plans.minimum_slice import scored_offers


def test_w1_w4_w6_ranges(offers):
    f = W.auction_features(landed_price(offers), with_platform=False)
    f = W.minmax(f, "CompetitionName", "IdealPointCompetition", suffix="_n")
    agg = f.agg(F.min("DifftoMinLandedPriceCompetition").alias("w1min"),
                F.max("IdealPointCompetition").alias("w4max"),
                F.min("IdealPointCompetition_n").alias("lo"), F.max("IdealPointCompetition_n").alias("hi")).first()
    assert agg["w1min"] == 0 and agg["w4max"] <= 0 and agg["lo"] >= 0 and agg["hi"] <= 1
    per = f.groupBy("CompetitionName").agg(F.min("DifftoMinLandedPriceCompetition").alias("m"))
    assert per.where("m != 0").count() == 0


def test_every_auction_gets_a_decided_winner(offers):
    s = scored_offers(offers)
    per = s.groupBy("CompetitionName").agg(F.max("NewDecision").alias("d"))
    assert per.where("d != 1").count() == 0


def test_split_is_a_partition_of_auctions(offers):
    train, test = W.auction_order_split(offers, 0.3, "auction_time")
    a_tr = {r[0] for r in train.select("CompetitionName").distinct().collect()}
    a_te = {r[0] for r in test.select("CompetitionName").distinct().collect()}
    n = offers.select("CompetitionName").distinct().count()
    assert not (a_tr & a_te) and len(a_tr) + len(a_te) == n and len(a_te) == round(0.3 * n)


def test_grid_sorted_within_bounds_and_recommendation_on_grid(offers):
    frame = RP.make_candidates(offers)
    cand = frame.where("is_candidate")
    bad = cand.where((F.col("LandedPrice") < F.col("lo") - 0.0051) | (F.col("LandedPrice") > F.col("hi") + 0.0051))
    assert bad.count() == 0
    sm = RP.smooth_curve(RP.score_candidates(frame, 0.5), ("CompetitionName",), 1, RP.CONTEXT)
    _, rec = RP.recommend(sm)
    on_grid = rec.join(cand.select("CompetitionName", F.round("LandedPrice", 2).alias("RecommendedPrice")),
                       on=["CompetitionName", "RecommendedPrice"], how="left_semi")
    assert on_grid.count() == rec.count() == offers.select("CompetitionName").distinct().count()


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vals = rng.normal(size=1001).round(3)
    groups = rng.integers(0, 3, size=1001)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    q = {r["g"]: r for r in quantiles(df, "v", [0.25, 0.5, 0.75], ["g"]).collect()}
    for g in range(3):
        ref = np.percentile(vals[groups == g], [25, 50, 75])
        assert [q[g]["q25"], q[g]["q50"], q[g]["q75"]] == pytest.approx(list(ref), abs=1e-9)
    r = global_rank(df, ["v", "g"]).agg(F.min("_rank"), F.max("_rank"), F.countDistinct("_rank")).first()
    assert tuple(r) == (0, 1000, 1001)


def brute_neighbours(pts, ids, queries, k, exclude_self=True):
    """Query id -> [(squared distance, id)], differences squared and added in the order of the dimensions."""
    import numpy as np
    out = {}
    for qid, q in queries:
        d = np.zeros(len(pts))
        for j in range(pts.shape[1]):
            d += (pts[:, j] - q[j]) * (pts[:, j] - q[j])
        near = sorted((float(x), i) for x, i in zip(d, ids) if not (exclude_self and i == qid))
        out[qid] = near[:k]
    return out


def points_frame(spark, pts, ids, labels):
    return spark.createDataFrame([(i, [float(x) for x in p], int(c)) for i, p, c in zip(ids, pts, labels)],
                                 "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("tree", [{}, {"fan_out": 4, "leaf_size": 16, "query_part": 20}])
def test_knn_matches_brute_force(spark, tree):
    """Neighbours of the metric tree equal the NumPy brute force: clusters, copies of one
    vector, ties, rows without a vector."""
    import numpy as np
    from bidscope.operators.knn import knn_vote, knn_votes
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(4, 8))
    pts = np.vstack([c + 0.05 * rng.normal(size=(60, 8)) for c in centers] + [np.tile(centers[:1], (80, 1)), rng.integers(0, 2, (30, 8))])
    labels, ids = rng.integers(0, 3, size=len(pts)), rng.permutation(len(pts)) * 3
    df = points_frame(spark, pts, ids.tolist(), labels).unionByName(
        spark.createDataFrame([(99_999, None, 1)], "vec_id long, embedding array<double>, label int"))
    want = brute_neighbours(pts, ids.tolist(), list(zip(ids.tolist(), pts)), 3)
    got = {}
    for r in knn_votes(df, 3, **tree).collect():
        got.setdefault(r["qid"], []).append((r["d"], r["pid"]))
    assert {i: sorted(x) for i, x in got.items()} == want
    label = dict(zip(ids.tolist(), labels.tolist()))
    votes = {r["vec_id"]: r["predicted"] for r in knn_vote(df, 3, **tree).collect()}
    for i, near in want.items():
        vals, counts = np.unique([label[p] for _, p in near], return_counts=True)
        assert votes[i] == int(vals[np.argmax(counts)])


def test_knn_of_other_queries_and_small_tables(spark):
    import numpy as np
    from bidscope.operators.knn import knn_votes
    rng = np.random.default_rng(3)
    pts, asked = rng.normal(size=(300, 4)), rng.normal(size=(40, 4)) * 3
    df = points_frame(spark, pts, range(300), np.zeros(300))
    qs = points_frame(spark, asked, range(40), np.zeros(40))
    want = brute_neighbours(pts, range(300), list(enumerate(asked)), 5, exclude_self=False)
    got = {}
    for r in knn_votes(df, 5, queries=qs, exclude_self=False, fan_out=4, leaf_size=16, query_part=7).collect():
        got.setdefault(r["qid"], []).append((r["d"], r["pid"]))
    assert {i: sorted(x) for i, x in got.items()} == want
    two = knn_votes(df.limit(2), 5).collect()
    assert sorted((r["qid"], r["pid"]) for r in two) == [(a, b) for a, b in ((0, 1), (1, 0))]
    assert knn_votes(df.limit(0), 3).collect() == []


def test_knn_compares_few_pairs_and_no_leaf_is_large(spark):
    """On clustered data fewer than n**1.5 distances, and no leaf above its size."""
    import numpy as np
    from bidscope.operators.knn import build_tree, nearest_vectors
    rng = np.random.default_rng(5)
    n = 4000
    pts = rng.normal(size=(80, 6))[rng.integers(0, 80, n)] * 10 + 0.1 * rng.normal(size=(n, 6))
    vectors = points_frame(spark, pts, range(n), np.zeros(n)).select(F.col("vec_id").alias("vid"), F.col("embedding").alias("v"))
    found = nearest_vectors(vectors, vectors.withColumnRenamed("vid", "qid"), 4, fan_out=8, leaf_size=64)
    assert found.agg(F.sum("compared")).first()[0] < n ** 1.5
    tree = build_tree(vectors, fan_out=8, leaf_size=64)
    assert tree.leaves.count() == n and tree.leaves.groupBy("leaf").count().agg(F.max("count")).first()[0] <= 64


def test_knn_sends_a_query_once_to_a_parcel(spark):
    """vectors of many dimensions, whose distances tell no leaves apart: a query is moved once for a
    parcel of points, not for each of the leaves it reaches, and its neighbours are exact."""
    import numpy as np
    from bidscope.operators import knn
    rng = np.random.default_rng(8)
    n, parcel = 600, 150
    pts = rng.normal(size=(n, 24))
    df = points_frame(spark, pts, range(n), np.zeros(n))
    vectors = df.select(F.col("vec_id").alias("vid"), F.col("embedding").alias("v"))
    tree = knn.build_tree(vectors, fan_out=8, leaf_size=24)
    known = vectors.select(F.col("vid").alias("qid"), "v", F.lit(1e6).alias("rq"), F.lit(0).cast("long").alias("own"))
    qs, ps = knn._dealt_to_parcels(known, tree, tree.leaves, 24, parcel)
    n_leaves = tree.leaves.select("leaf").distinct().count()
    assert qs.count() <= n * (8 + n // parcel) < n * n_leaves
    assert ps.count() == n * (n // parcel)
    want = brute_neighbours(pts, range(n), list(enumerate(pts)), 3)
    got = {}
    for r in knn.knn_votes(df, 3, fan_out=8, leaf_size=24).collect():
        got.setdefault(r["qid"], []).append((r["d"], r["pid"]))
    assert {i: sorted(x) for i, x in got.items()} == want


def test_previous_win_with_a_hot_key(spark):
    """One seller with a third of all wins; ranges give the pairs of one window."""
    from bidscope.operators.events import previous_win
    from pyspark.sql import Window
    rows = [(f"a{i}", "hot" if i % 3 == 0 else f"w{i % 17}", float(i * 7 % 1000), "m", "p", i % 2, float(i))
            for i in range(3000)]
    wins = spark.createDataFrame(rows, "File string, WinnerId string, Time double, MarketplaceId string, "
                                       "ProductId string, IsCustomer int, LandedPrice double")
    got = previous_win(wins, ["Time", "File"])
    w = Window.partitionBy("MarketplaceId", "WinnerId", "ProductId").orderBy("Time", "File")
    want = wins.select("MarketplaceId", "WinnerId", "ProductId", F.lag("File").over(w).alias("File"),
                       F.lag("Time").over(w).alias("Time"), F.lag("IsCustomer").over(w).alias("IsCustomer"),
                       F.lag("LandedPrice").over(w).alias("LandedPrice"), F.col("IsCustomer").alias("Next"),
                       F.col("File").alias("NextId"), F.col("LandedPrice").alias("NextPrice")).dropna()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_markets_table_and_local_dimension(spark, offers):
    from bidscope.schema import PLATFORM_SELLERS, platform_dimension
    dim = platform_dimension(spark)
    assert W.local_table(dim).count() == len(PLATFORM_SELLERS) and W.local_table(dim, 3) is dim
    row = spark.createDataFrame([("A1PA6795UKMFR9", "x"), ("??", "y")], "MarketplaceId string, SellerId string")
    got = {r["MarketplaceId"]: r["PlatformSellerId"] for r in W.platform_seller(row, dim).collect()}
    assert got == {"A1PA6795UKMFR9": "A3JWKAKR8XB7XF", "??": "nothing"}
    assert W.known_markets(row, dim).count() == 1


def test_half_cent_grid_end_is_the_same_on_every_host(spark):
    """lo = mid and hi on a half cent: the snap decides, not the last bit of pow."""
    from bidscope.functions.grid import grid_cents
    xs = [1.005, 2.675, 10.125, 64.1250000000001, 64.1249999999999, 3.14159]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(grid_cents(F.col("x"))).collect()]
    assert got == [1.0, 2.68, 10.12, 64.12, 64.12, 3.14]


def test_matrix_forms_agree(spark, offers):
    from bidscope.operators.metrics import auction_count, confusion_matrix, confusion_wide
    s = scored_offers(offers)
    long = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(s, "IsBuyBoxWinner", "NewDecision").collect()}
    wide = {(r["actual"], p): r[str(p)] for r in confusion_wide(s, "IsBuyBoxWinner", "NewDecision").collect() for p in (-1, 1)}
    assert long == wide
    assert auction_count(offers).first()[0] == offers.select("CompetitionName").distinct().count()


def test_quantiles_without_groups_and_with_ties(spark):
    import numpy as np
    vals = [1.0] * 50 + [2.0] * 3 + [7.5, None]
    df = spark.createDataFrame([(v, "g") for v in vals], "v double, g string")
    want = np.percentile([v for v in vals if v is not None], [25, 50, 95])
    for by in ([], ["g"]):
        r = quantiles(df, "v", [0.25, 0.5, 0.95], by).first()
        assert [r["q25"], r["q50"], r["q95"]] == pytest.approx(list(want))


def test_polynomials_of_a_batch_equal_numpy(spark):
    """Groups of many sizes, fewer points than coefficients among them."""
    import numpy as np
    import warnings
    rng = np.random.default_rng(4)
    rows = [(g, float(x), float(rng.normal())) for g in range(30) for x in np.sort(rng.uniform(9, 12, 1 + g % 12))]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    got = {}
    for r in RP.poly_smooth(df, ["g"], "x", "y", 5).orderBy("g", "x").collect():
        got.setdefault(r["g"], []).append(r["Smoothed"])
    for g in range(30):
        x, y = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            assert got[g] == pytest.approx(list(np.polyval(np.polyfit(x, y, 5), x)), abs=1e-5)


def test_orthogonal_curve_equals_numpy_where_that_keeps_full_rank(spark):
    """R4 as expressions: groups of many sizes, repeated prices, one price, fewer prices than coefficients."""
    import numpy as np
    rng = np.random.default_rng(6)
    rows = [(f"a{g}", float(x), float(rng.normal())) for g in range(30) for x in rng.uniform(9, 12, 1 + 2 * g)]
    rows += [("two", x, y) for x, y in ((1.0, 3.0), (1.0, 5.0), (2.0, 7.0))] + [("one", 4.0, 8.0), ("same", 4.0, 1.0), ("same", 4.0, 2.0)]
    df = spark.createDataFrame(rows, "CompetitionName string, x double, y double").repartition(4)
    got = {}
    for r in RP.orthogonal_smooth(df, ["CompetitionName"], "x", "y", 5).collect():
        got.setdefault(r["CompetitionName"], []).append((r["x"], r["y"], r["Smoothed"]))
    for g, found in got.items():
        x, y, fit = (np.array(c) for c in zip(*found))
        t = x - x.mean()
        least = np.vander(t, 6) @ np.linalg.lstsq(np.vander(t, 6), y, rcond=None)[0]
        assert fit == pytest.approx(least, abs=1e-6), g


def test_orthogonal_curve_golden_and_plan(spark):
    """The worked curve; seven windows of one key behind one exchange, no Python."""
    xs = [10.0, 10.1, 10.2, 10.3, 10.4, 10.5, 10.6]
    ys = [100.0, 90.0, 70.0, 40.0, 30.0, 10.0, 0.0]
    df = spark.createDataFrame([("k", x, y) for x, y in zip(xs, ys)], "CompetitionName string, x double, y double")
    out = RP.orthogonal_smooth(df, ["CompetitionName"], "x", "y", 5)
    assert [r["Smoothed"] for r in out.orderBy("x").collect()] == pytest.approx(
        [99.7836, 91.2987, 66.7533, 44.3290, 26.7533, 11.2987, -0.2164], abs=1e-3)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert executed.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("direct,buckets", [(None, None), (10, 32), (1, 256)])
def test_quantiles_by_narrowing(spark, monkeypatch, direct, buckets):
    """Histogram passes: hot groups, ties, infinities, subnormals, huge and equal values, NaN and null."""
    import numpy as np
    from bidscope.operators import ranking
    if direct:
        monkeypatch.setattr(ranking, "DIRECT", direct)
        monkeypatch.setattr(ranking, "BUCKETS", buckets)
    rng = np.random.default_rng(8)
    groups = {"hot": rng.lognormal(0, 9, 3000), "ties": rng.integers(0, 5, 500) / 3, "one": [7.5], "same": [2.0] * 90,
              "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0, 2.0], "inf": [float("-inf"), float("inf"), 1.0, 2.0, 3.0, float("inf")],
              "signs": rng.normal(0, 1, 401), None: rng.normal(5, 1, 33)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("hot", None), ("hot", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in ranking.quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], ["g"]).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        with np.errstate(all="ignore"):
            want = np.quantile(np.array(xs, float), [0, 0.25, 0.5, 0.9, 1])
        for name, w in zip(("q0", "q25", "q50", "q90", "q100"), want):
            if np.isfinite(w) and abs(w) < 1e300:
                assert got[g][name] == pytest.approx(w, rel=1e-12, abs=1e-300), (g, name)
    d = {r["g"]: r for r in ranking.describe(df, "v", ["g"]).collect()}
    assert d["hot"]["count"] == 3000 and d["none"]["count"] == 0 and d["none"]["p50"] is None
    alone = ranking.describe(df.where("g = 'signs'"), "v").first()
    assert alone["p50"] == pytest.approx(np.median(groups["signs"])) and alone["count"] == 401
    assert ranking.describe(df.where("false"), "v", ["g"]).collect() == []


def test_duplicate_columns_of_a_wide_table(spark):
    """F1 by fingerprints: 300 columns in one aggregate; copies, numbers with holes, texts with holes,
    families, signs of zero, columns of equal values in another order."""
    from bidscope.operators.clean import drop_duplicate_columns
    n = 60
    cols = {f"x{i}": [(i * 7 + r * r) % 97 for r in range(n)] for i in range(280)}
    cols |= {"x_copy": cols["x5"], "x_turned": cols["x5"][::-1], "zero": [0.0, -0.0] * 30, "minus": [-0.0, 0.0] * 30,
             "hole": [None, *range(n - 1)], "hole_copy": [None, *range(n - 1)], "nan": [float("nan"), *map(float, range(n - 1))],
             "nan_copy": [float("nan"), *map(float, range(n - 1))], "text": [None, *"ab"] * 20, "text_copy": [None, *"ab"] * 20}
    rows = list(zip(*cols.values()))
    kind = lambda c: "string" if c.startswith("text") else "double" if c[:3] in ("zer", "min", "nan") else "long"
    df = spark.createDataFrame(rows, ", ".join(f"{c} {kind(c)}" for c in cols)).withColumn("x_int", F.col("x9").cast("int")).repartition(3)
    kept = set(drop_duplicate_columns(df, protect=()).columns)
    cols["x_int"] = cols["x9"]
    names = list(cols)
    copy = lambda a, b: kind(a) == kind(b) and cols[a] == cols[b] and (kind(a) == "string" or all(v == v and v is not None for v in cols[a]))
    want = {a for i, a in enumerate(names) if any(copy(a, b) for b in names[i + 1:])}
    assert {"x5", "x9", "zero", "text"} < want and set(df.columns) - kept == want
    last = {"x_int", "nan_copy", "text_copy"}          # no rows: every column but the last of its family
    assert set(drop_duplicate_columns(df.where("false"), protect=()).columns) == last


def test_previous_win_by_windows_and_by_ranges_agree(spark):
    from bidscope.operators.events import previous_win
    rows = [(f"a{i}", "hot" if i % 3 == 0 else f"w{i % 17}", float(i * 7 % 1000), None if i % 4 else "m", "p", i % 2, float(i))
            for i in range(3000)]
    wins = spark.createDataFrame(rows, "File string, WinnerId string, Time double, MarketplaceId string, "
                                       "ProductId string, IsCustomer int, LandedPrice double")
    plain, mixed, ranged = (previous_win(wins, ["Time", "File"], hot_key_rows=n) for n in (10_000, 300, 1))
    assert plain.count() == mixed.count() == ranged.count()
    assert plain.exceptAll(mixed).count() == 0 and plain.exceptAll(ranged).count() == 0


def test_clean_report_moves_hashes_and_counts_as_the_steps_do(spark):
    """copies, constant, sparse and duplicate columns, auctions with no, one and two winners, a null
    auction; the exchange by auction holds no column of the rows."""
    from bidscope.operators import clean as C
    rows = [(a, i, 1 if i < w else -1, float(i), float(i), "x", None if i else "new")
            for a, w in (("a", 0), ("b", 1), ("c", 2), ("d", 1), (None, 1), *((x, 1) for x in "efghi")) for i in range(3)]
    df = spark.createDataFrame(rows + rows[:7], "CompetitionName string, SellerId int, IsBuyBoxWinner int, "
                               "p double, q double, k string, SubCondition string")
    got = {r["step"]: tuple(r)[1:] for r in C.clean_report(df).collect()}
    d1 = C.drop_duplicate_columns(df)
    d2 = C.drop_duplicate_rows(d1)
    d3 = C.drop_constant_columns(d2)
    d4 = C.drop_sparse_columns(d3)
    d5 = C.exactly_one_winner(d4)
    n = [x.count() for x in (df, d2, d5)]
    w = [len(x.columns) for x in (df, d1, d3, d4)]
    assert got == {"duplicate_columns": (n[0], n[0], w[0], w[1], "p"), "duplicate_rows": (n[0], n[1], w[1], w[1], ""),
                   "constant_columns": (n[1], n[1], w[1], w[2], "k"), "sparse_columns": (n[1], n[1], w[2], w[3], "SubCondition"),
                   "one_winner": (n[1], n[2], w[3], w[3], "")}
    assert C._distinct_counts_by_auction(df, ["SubCondition"]) == (n[1], n[2], {"SubCondition": 10})
