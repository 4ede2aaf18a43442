"""op2 against exhaustive search over all places."""

import random
import re

import pytest
from llm_fixtures import prose

from bidscope.llm.decontaminate import clean_documents, contaminated, lcs


def words(t):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def test_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(90))] for _ in range(2))
        assert lcs(a, b) == slow_lcs(a, b)


@pytest.fixture
def planted(spark, rng):
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    common = [f"c{i}" for i in range(30)]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < .4 else rng.choice(vocab) for _ in range(n))

    items = [(i, ". ".join(text(rng.randint(8, 22)) for _ in range(2)) + ".") for i in range(25)]
    rows, truth, edited = [], set(), set()
    for d in range(200):
        body = text(rng.randint(0, 400)).split()
        if d % 4 == 0:
            i, t = items[rng.randrange(25)]
            ws = t.split()
            if d % 8 == 0:
                ws = [w.upper() + "," for w in ws]
                truth.add((d, i))
            else:
                for _ in range(len(ws) // 8):
                    ws[rng.randrange(len(ws))] = rng.choice(vocab)
                edited.add((d, i))
            at = rng.randint(0, len(body))
            body[at:at] = ws
        rows.append((d, " ".join(body)))
    rows += [(1000, None), (1001, "")]
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
            spark.createDataFrame([*items, (90, None), (91, ""), (92, "zq zr zs")], "item_id long, text string"), truth, edited)


def test_finds_copies_and_edits_and_nothing_else(planted):
    docs, bench, truth, edited = planted
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert truth <= got
    assert len(edited & got) >= 0.9 * len(edited)
    assert got <= truth | edited
    blocks = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench, block_items=7).collect()}
    assert blocks == got
    kept = {r["doc_id"] for r in clean_documents(docs, contaminated(docs, bench)).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in got}


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r["item_id"]: " ".join(words(r["text"])) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items()
            if f" {t} " in f" {' '.join(words(r['text']))} "}
    hits = contaminated(docs, bench).collect()
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in hits}
    for r in hits:
        assert 0 < r["lcs"] <= r["item_words"] and r["cosine"] >= 0.5


def test_empty_tables_and_repeats(spark):
    t = prose(random.Random(2), 40)
    docs = spark.createDataFrame([(1, t, 3), (1, t, 4), (None, t, 5)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, t, "x"), (8, t, "y")], "item_id long, text string, doc_id string")
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in contaminated(docs, bench).collect())
    assert got == [(0, 7), (0, 8), (1, 7), (1, 7), (1, 8), (1, 8)]
    assert contaminated(docs.limit(0), bench).collect() == []
    assert contaminated(docs, bench.limit(0)).collect() == []
    assert clean_documents(docs, contaminated(docs, bench)).collect() == []


def test_basis_is_fit_on_all_passages():
    import numpy as np
    import pyarrow as pa

    from bidscope.llm import decontaminate as D
    from bidscope.llm import textkernels as K
    from bidscope.llm.quality import random_matrix
    rng, passage, dims, width = random.Random(5), 8, 64, 6
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(50)] + ["", "a a a"]
    idf = np.random.default_rng(1).random(dims).astype(np.float32) + np.float32(.1)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (got,) = D._products(passage, dims, idf, width, 3)([batch])
    got = np.frombuffer(b"".join(got.column(1).to_pylist())).reshape(dims, width)
    rows = []
    for t in texts:
        h = D.Items._words(pa, t)
        rows += [np.bincount((h[i:i + passage] % np.uint64(dims)).astype(int), minlength=dims) * idf for i in range(0, len(h), passage)]
    x = np.array([r / np.linalg.norm(r) for r in rows])
    np.testing.assert_allclose(got, x.T @ (x @ random_matrix(dims, width, 3)), rtol=1e-4, atol=1e-4)


def test_basis_does_not_depend_on_a_sample(spark, monkeypatch):
    from bidscope.llm import decontaminate as D
    rng, seen = random.Random(6), []
    docs = spark.createDataFrame([(i, prose(rng, 640)) for i in range(2200)], "doc_id long, text string")     # 22,000 passages
    summed = D.sums.summed

    def spy(parts, shape):
        out = summed(parts, shape)
        seen.append(out)
        return out
    monkeypatch.setattr(D.sums, "summed", spy)
    D.latent_terms(docs, 64, 256, 4, 6, seed=2)
    import numpy as np
    df = seen[0]
    idf = (np.log((1 + df[256]) / (1 + df[:256]))).astype(np.float32) + np.float32(1e-3)
    texts = docs.select("text")
    full = summed(texts.mapInArrow(D._products(64, 256, idf, 6, 2), D.sums.PARTS), (256, 6))
    assert df[256] == 22_000
    np.testing.assert_allclose(seen[1], full, rtol=1e-6, atol=1e-6)


def test_a_copy_beside_its_scrambled_words_is_found():
    import types

    import numpy as np
    import pyarrow as pa

    from bidscope.llm import decontaminate as D
    rng = random.Random(8)
    item = [f"q{i}" for i in range(32)]
    mixed = item * 2
    rng.shuffle(mixed)
    other = [f"z{i}" for i in range(8)]
    text = " ".join([*mixed, *item[:28], *other])         # 28 of 32 words copied, after a stretch of all of them
    terms = np.random.default_rng(2).standard_normal((512, 24)).astype(np.float32)
    items = D.Items([7], [" ".join(item)], terms, 8)
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([1])], names=["text", "doc_id"])
    search = D._search(types.SimpleNamespace(value=(terms, items)), 8, 0.3, 0.8, 0.6, 8)
    (hits,) = search([batch])
    assert [(r["doc_id"], r["item_id"]) for r in hits.to_pylist()] == [(1, 7)] and hits.to_pylist()[0]["lcs"] == 28


def test_short_items_are_found_at_any_cosine(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 200)) for i in range(30)]
    rows[4] = (4, rows[4][1] + " Zq, zr zs. " + rows[4][1])
    rows[5] = (5, rows[5][1] + " zq zr between zs " + rows[5][1])
    bench = spark.createDataFrame([(1, "zq zr zs"), (2, "zq ZR zs!"), (3, "zs zq")], "item_id long, text string")
    hits = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in hits if r["cosine"] == 1.0} == {(4, 1), (4, 2)}
    assert {r["place"] for r in hits if r["cosine"] == 1.0} == {200}
