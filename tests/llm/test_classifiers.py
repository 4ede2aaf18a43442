"""op9 and op10: held-out accuracy on planted signals, exact kernels, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import textkernels as K
from bidscope.llm.catalog import fold
from bidscope.llm.quality import leading_directions, random_matrix, score_quality, term_counts, vote
from bidscope.llm.toxicity import features, fit_nnpu, score_toxicity

SF = "/root/testdata/sf0.01"


def auc(y, x):
    y, x = np.array(y), np.array(x, float)
    _, at, n = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = (score_quality(docs.select("doc_id", "text"), labels, fold(5) != 0)
           .join(labels, "doc_id").where(fold(5) == 0).select("quality", "score").toPandas())
    assert auc(got["quality"], got["score"]) > 0.97


def test_toxicity_held_out(spark):
    """Planted words: no label of the held-out fold is learned."""
    rng = np.random.default_rng(0)
    words = np.array([f"w{i}" for i in range(3000)])
    bad = np.array(["vile", "scummy", "rotten"])
    rows, y = [], []
    for i in range(900):
        ws = list(rng.choice(words, rng.integers(5, 80)))
        toxic = i % 5 == 0
        if toxic:
            ws += list(rng.choice(bad, 2))
        rows.append((i, " ".join(ws)))
        y.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([r for r in y if r[0] % 2], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels, fold(3) != 1).collect()}
    held = [i for i, _, _ in y if i % 2 == 0]
    assert auc([y[i][2] for i in held], [got[i] for i in held]) > 0.98
    assert np.mean([got[i] >= 0.7 for i in held if y[i][2]]) > 0.9
    assert np.mean([got[i] < 0.7 for i in held if not y[i][2]]) > 0.95


def test_empty_texts_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (None, "x y"), (3, "a" * 50_000), (3, "a" * 50_000)],
                                 "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fn in (score_quality, score_toxicity):
        got = fn(docs, none, F.lit(True)).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert fn(docs.limit(0), none, F.lit(True)).collect() == []


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "z", "t", "s", "r")],
                                 "doc_id long, text string, quality int, _y string, _text string, score string, row string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for fn, more in ((score_quality, {}), (score_quality, {"keep_text": True}), (score_toxicity, {})):
        row, = fn(docs, labels, F.lit(True), **more).collect()
        assert (row["quality"], row["_y"], row["_text"], row["row"]) == (5, "z", "t", "r")
        assert 0 <= row["score"] <= 1 and ("text" in row.asDict()) == bool(more)
    assert score_quality(docs, labels, F.lit(True)).first()["score"] == pytest.approx(0.5)


def test_vote_is_exact():
    rng = np.random.default_rng(1)
    z, v = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(700, 8)), rng.normal(size=(50, 8))))
    y = rng.integers(0, 2, 50).astype(float)
    got = vote(z, v, y, 7, 0.5, 1.0)
    for i in range(0, 700, 97):
        sim = v @ z[i]
        near = np.argsort(-sim)[:7]
        w = np.maximum(sim[near], 0) * np.where(y[near] == 1, 25 / y.sum(), 25 / (50 - y.sum()))
        assert got[i] == pytest.approx((w @ y[near] + 0.5) / (w.sum() + 1))


def test_directions_span_a_low_rank_matrix():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 60))
    w = random_matrix(60, 12, 0)
    basis, spectrum = leading_directions(x.T @ (x @ w), w, 5)
    assert np.allclose(spectrum, np.linalg.svd(x, compute_uv=False)[:5])
    assert np.allclose(x @ basis @ basis.T, x, atol=1e-3)


def test_terms_and_features_follow_the_words():
    import pyarrow as pa
    (_, _, off, body), = K.slices(pa.array(["Big big words", "", "words, WORDS!"]))
    counts = term_counts(off, body, 2048)
    assert counts.sum(1).tolist() == [9, 0, 6]
    row, h = features(off, body)
    assert sorted(row.tolist()) == [0, 0, 0, 2, 2] and len(set(h[row == 2].tolist())) == 1


def test_risk_stays_finite_without_overfitting_to_the_sample():
    pos = (np.arange(20), np.zeros(20, int), 20)
    unl = (np.arange(10), np.zeros(10, int), 200)
    w, b = fit_nnpu(pos, unl, 1, 0.1)
    assert np.isfinite(w).all() and w[0] + b > 0 > b


def test_toxic_markers_are_chosen_by_z_not_by_frequency(spark):
    import numpy as np

    from bidscope.llm.toxicity import clearest, score_toxicity
    assert clearest(np.array([1., -9, 5, 4, 7]), 4, 3).tolist() == [1, 2, 4]
    common = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"{common} u{i}" + (f" rare{i % 3}" if i < 30 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i < 24 else 0) for i in range(24)] + [(i, 0) for i in range(30, 60)],
                                   "doc_id long, toxic int")
    from pyspark.sql import functions as F
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels, F.lit(True), max_features=20).collect()}
    assert min(got[i] for i in range(24, 30)) > max(got[i] for i in range(60, 300))


# ---- dense versions of both classifiers ------------------------------------------------------

def plain_terms(text, dims):
    """Counts of op9's terms of one text, word by word."""
    from bidscope.llm.quality import _KIND, _SHAPES
    out, before = np.zeros(dims), None
    one = lambda x: int(K.span_hashes(K.byte_sums(np.frombuffer(x, np.uint8)), np.array([0]), np.array([len(x)]))[0])
    for w in (text or "").encode().split():
        kinds = [int(_KIND[w[i]]) for i in (0, len(w) // 2, -1)]
        out[((kinds[0] * 5 + kinds[1]) * 5 + kinds[2]) * 4 + min(len(w) // 5, 3)] += 1
        out[_SHAPES + (w == before)] += 1
        out[_SHAPES + 2 + one(w[-3:]) % (dims - _SHAPES - 2)] += 1
        before = w
    return out


def test_quality_equals_a_dense_version(spark):
    """op9 step by step with whole matrices: counts, IDF, one random product, eigenvectors, cosines, vote."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(9001, None), (9002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dims, rank, width, k = 2048, 32, 40, 25
    got = {r["doc_id"]: r["score"] for r in score_quality(docs, labels, fold(5) != 0).collect()}
    counts = np.array([plain_terms(t, dims) for _, t in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1
    x = np.sqrt(counts) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    basis, _ = leading_directions(x.T @ (x @ random_matrix(dims, width, 9)), random_matrix(dims, width, 9), rank)
    z = x @ basis
    size = np.linalg.norm(z, axis=1, keepdims=True)
    z = z / np.where(size > 1e-6, size, np.inf)
    of = {r["doc_id"]: float(r["quality"]) for r in labels.where(fold(5) != 0).where("quality is not null").collect()}
    at = [i for i, (d, _) in enumerate(rows) if d in of]
    y = np.array([of[rows[i][0]] for i in at])
    k = max(1, min(k, int(min((y > 0.5).sum(), (y <= 0.5).sum()))))
    half = np.where(y > 0.5, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    far = 0
    for i, (d, _) in enumerate(rows):
        sim = z[at] @ z[i]
        near = np.argsort(-sim, kind="stable")[:k]
        weight = np.maximum(sim[near], 0) * half[near]
        want = (weight @ y[near] + y.mean()) / (weight.sum() + 1)
        far += abs(want - got[d]) > 0.02       # float32 cosines may swap the last of equal neighbours
    assert far <= 0.02 * len(rows)


def test_toxicity_equals_a_dense_version(spark):
    """op10 with sets of words and whole matrices: candidates, z, slices, risk, mean."""
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(400)])
    rows, y = [], {}
    for i in range(500):
        ws = list(rng.choice(words, rng.integers(3, 40)))
        if i % 6 == 0:
            ws += list(rng.choice(["vilest-thing", "Scummy", "rottenness"], 2))
        rows.append((i, " ".join(ws)))
        if i % 2 == 0:
            y[i] = int(i % 6 == 0)
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(list(y.items()), "doc_id long, toxic int")
    learn = F.col("doc_id") % 5 != 0
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels, learn, slice_rows=120).collect()}

    def bag(text):
        out = set()
        for w in "".join(c.lower() if c.isalnum() or ord(c) > 126 or c.isspace() else " " for c in text or "").split():
            out |= {(0, w)} | {(n, w[:n]) for n in (6, 8) if len(w) >= n}
        return out

    bags = {i: bag(t) for i, t in rows}
    base = [i for i, _ in rows if i % 5]
    pos = [i for i in base if y.get(i) == 1]
    prior = np.mean([v for i, v in y.items() if i % 5])
    count = lambda of: {f: sum(f in bags[i] for i in of) for f in set().union(*(bags[i] for i in pos))}
    in_pos, in_all = count(pos), count(base)
    z = {}
    for f, n in in_pos.items():
        if n >= 3:
            p, u = (n + .5) / (len(pos) + 1), (in_all[f] + .5) / (len(base) + 1)
            z[f] = (p - u) / np.sqrt(u * (1 - u) / len(pos))
    kept = sorted(f for f in z if abs(z[f]) >= 4)
    assert 3 <= len(kept) < 100
    x = {i: np.array([f in bags[i] for f in kept], float) for i, _ in rows}
    slices = max(1, -(-len(base) // 120))
    of = {r["doc_id"]: r["s"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(slices)).alias("s")).collect()}
    csr = lambda ids: (*np.nonzero(np.array([x[i] for i in ids])), len(ids))
    fits = [fit_nnpu(csr(pos), csr([i for i in base if of[i] == s]), len(kept), prior) for s in range(slices)]
    w, b = np.mean([f[0] for f in fits], axis=0), np.mean([f[1] for f in fits])
    for i, _ in rows:
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(x[i] @ w + b))), abs=1e-6)
