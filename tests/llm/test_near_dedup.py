"""op7: signatures are unbiased, classes equal those of all exact links."""

from collections import Counter

import numpy as np
import pytest

from bidscope.llm import textkernels as K
from bidscope.llm.near_dedup import bags, block_rows, drop_near_duplicates, near_dedup, signatures


def bag(text, k=5):
    ws = (text or "").encode().split()
    if 0 < len(ws) < k:
        return Counter([tuple(ws)])
    return Counter(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))


def brute(rows, least=0.8):
    bags_, parent = {i: bag(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(bags_)
    for a in ids:
        for b in ids:
            if a < b:
                x, y = bags_[a], bags_[b]
                low, high = sum((x & y).values()), sum((x | y).values())
                if high == 0 or low / high >= least:
                    ra, rb = sorted((root(a), root(b)))
                    parent[rb] = ra
    return {i: root(i) for i in ids}


def near_copies(rng, base, n, share):
    from llm_fixtures import WORDS
    out = []
    for _ in range(n):
        ws = base.split()
        for _ in range(max(1, int(len(ws) * share))):
            ws[rng.randrange(len(ws))] = rng.choice(WORDS) + "new"
        out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("block", [256, 8])
def test_classes_equal_all_links(spark, corpus, rng, monkeypatch, block):
    from bidscope.llm import near_dedup as module
    from llm_fixtures import prose
    monkeypatch.setattr(module, "BLOCK", block)
    rows = list(corpus)
    for share, n in ((0.005, 30), (0.02, 25), (0.03, 25)):
        rows += [(10_000 + len(rows) + i, t) for i, t in enumerate(near_copies(rng, prose(rng, 200), n, share))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup(df).collect()}
    want = brute(rows)
    assert got == want
    assert max(Counter(want.values()).values()) >= 25 and len(set(want.values())) < 0.75 * len(rows)


def test_registers_agree_as_often_as_the_weighted_jaccard():
    rng, m = np.random.default_rng(5), 4096
    sh = K.mix(np.arange(1, 41, dtype=np.uint64))
    a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
    row = np.repeat([0, 1], 40)
    both = np.concatenate([a, b])
    use = both > 0
    sig = signatures(row[use], np.tile(sh, 2)[use], both[use], 2, m)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m)


def test_bags_count_runs():
    import pyarrow as pa
    texts = ["a b c d e a b c d e a", "x y", "", "a b c d e"]
    (_, _, off, body), = K.slices(pa.array(texts))
    r, s, c, _, _ = bags(off, body, 5)
    assert [sorted(c[r == i].tolist()) for i in range(4)] == [sorted(bag(t).values()) for t in texts]
    assert s[r == 3][0] in s[r == 0]


def test_repeated_rows_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None), (5, " ")],
                               "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["class_id"], r["class_size"], r["kept"]) for r in near_dedup(df).collect())
    assert got == [(0, None, 3, True), (3, None, 3, False), (3, None, 3, False), (4, 4, 2, True), (5, 4, 2, False)]
    assert near_dedup(df.limit(0)).collect() == []


def test_rows_of_one_id_or_without_id_are_told_apart_by_their_text(spark, rng):
    from llm_fixtures import prose
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    df = spark.createDataFrame([(None, a), (None, b), (7, c), (7, d), (8, c), (9, d), (9, d)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["class_size"], r["kept"]) for r in near_dedup(df).collect())
    assert got == [(0, 0, 1, True), (0, 0, 1, True), (7, 7, 2, True), (7, 7, 3, True), (8, 7, 2, False), (9, 7, 3, False), (9, 7, 3, False)]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in drop_near_duplicates(df).collect())
    assert kept == sorted([(0, a), (0, b), (7, c), (7, d)])


def test_clashing_columns_and_long_texts(spark, rng):
    from llm_fixtures import prose
    long = prose(rng, 30_000)
    rows = [(1, long), (2, long.replace("a", "a", 1) + " tail"), (3, prose(rng, 80)), (4, None), (5, " x " + long)]
    df = spark.createDataFrame([(i, t, 1, 2, 3, "k", 4.0) for i, t in rows],
                               "doc_id long, text string, key int, _doc int, rep int, class string, size double")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert kept.where("_doc = 2 and rep = 3 and class = 'k' and size = 4.0").count() == 3


def test_rows_in_blocks_grow_with_the_members(spark):
    """A bucket of one large component and few others: each member stands in few blocks."""
    made = {}
    for n in (1000, 4000, 16000):
        key = "named_struct('id', {0}, 'sub', 0L)"
        state = spark.range(n).selectExpr("1L as bucket", "0 as band", f"{key.format('id')} as rep", "9L as size",
                                          f"{key.format('if(id < 40, id, 99L)')} as comp")
        made[n] = block_rows(state).count()
    assert made[16000] <= 4.2 * made[4000] <= 4.2 ** 2 * made[1000]


def test_blocks_look_at_every_pair_that_matters(spark, monkeypatch):
    from bidscope.llm import near_dedup as module
    monkeypatch.setattr(module, "BLOCK", 7)
    key = "named_struct('id', {0}, 'sub', 0L)"
    state = spark.range(60).selectExpr("id % 2 as bucket", "0 as band", f"{key.format('id')} as rep", "9L as size",
                                       f"{key.format('if(id % 3 = 0, id, 1L)')} as comp")
    met = set()
    groups = {}
    for r in block_rows(state).collect():
        groups.setdefault((r["bucket"], r["lo"], r["hi"]), []).append((r["blk"], r["rep"]["id"]))
    for (_, lo, hi), rows in groups.items():
        met |= {(min(a, b), max(a, b)) for x, a in rows for y, b in rows if a != b and {x, y} == {lo, hi}}
    comp = {i: i if i % 3 == 0 else 1 for i in range(60)}
    assert met >= {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 2 == b % 2 and comp[a] != comp[b]}
