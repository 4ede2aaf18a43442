"""op3 against an exhaustive search for repeated runs, and its guarantee."""

import numpy as np
import pytest

from bidscope.llm import textkernels as K
from bidscope.llm.line_dedup import line_dedup, range_argmin, selected


def lines_of(t):
    return [tuple(x.split()) for x in (t or "").encode().split(b"\n") if x.strip()]


@pytest.fixture
def rows(rng):
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    blocks = [[rng.choice(pool) for _ in range(rng.randint(3, 8))] for _ in range(10)]
    out = []
    for i in range(120):
        ls = [rng.choice(pool) + f" only{i}" for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            at = rng.randint(0, len(ls))
            ls[at:at] = rng.choice(blocks)
        if i % 10 == 0:
            ls = ls * 2
        out.append((i * 2, "\n".join(x + "  " * (i % 2) for x in ls) + "\n\n" * (i % 4)))
    return [*out, (900, None), (901, ""), (902, "\n \n"), (903, "x\n" * 300)]


def exact(rows, gram, min_words):
    """A line goes when a run around it, long enough, also stands at an earlier place."""
    seqs = {i: lines_of(t) for i, t in rows}
    first, gone = {}, {i: set() for i in seqs}
    for i in sorted(seqs):
        for a in range(len(seqs[i])):
            for b in range(a + gram, len(seqs[i]) + 1):
                if sum(map(len, seqs[i][a:b])) >= min_words:
                    if first.setdefault(tuple(seqs[i][a:b]), (i, a)) != (i, a):
                        gone[i] |= set(range(a, b))
    return {i: (len(seqs[i]), len(gone[i]), [x for j, x in enumerate(seqs[i]) if j not in gone[i]]) for i in seqs}


def found(docs, **how):
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], lines_of(r["text"])) for r in line_dedup(docs, **how).collect()}


@pytest.mark.parametrize("gram,least", [(2, 10), (1, 1), (3, 0), (1, 10)])
def test_matches_brute_force(spark, rows, gram, least):
    rows = [r for r in rows if r[0] != 903]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string").repartition(5)
    got = found(df, gram=gram, min_words=least)
    assert got == exact(rows, gram, least)
    assert any(v[1] for v in got.values())


def test_one_line_over_and_over(spark):
    df = spark.createDataFrame([(903, "x\n" * 300), (904, "x\n" * 9), (905, "x\n" * 10)], "doc_id long, text string")
    assert {i: v[:2] for i, v in found(df).items()} == {903: (300, 299), 904: (9, 0), 905: (10, 10)}


def test_every_long_run_is_found_and_a_copy_stays(spark, rows):
    got = {i: v[2] for i, v in found(spark.createDataFrame(rows, "doc_id long, text string"), gram=2, min_words=0).items()}
    all_lines = {x for _, t in rows for x in lines_of(t)}
    assert {x for ls in got.values() for x in ls} == all_lines
    seen = {}
    for i in sorted(got):
        before = {x for j in got if j < i for k in range(len(got[j]) - 2) for x in [tuple(got[j][k:k + 3])]}
        seen[i] = [k for k in range(len(got[i]) - 2) if tuple(got[i][k:k + 3]) in before]
    assert not any(seen.values())


def sequence(rng, docs=30):
    """Line hashes, rows, words and first places of random texts."""
    sizes = [int(x) for x in rng.integers(0, 25, docs)]
    row = np.repeat(np.arange(docs), sizes)
    h = K.mix(rng.integers(0, 60, len(row)).astype(np.uint64))
    words = (h % np.uint64(13) + np.uint64(1)).astype(np.int64)
    return h, row, words, K.first_places(row, docs)


@pytest.mark.parametrize("gram,least", [(1, 10), (2, 5), (1, 40)])
def test_both_copies_of_a_repeated_run_select_the_same_line(gram, least):
    h, row, n, first = sequence(np.random.default_rng(2))
    place, left, right, owner, a, b = selected(h, row, n, first, gram, least)
    assert len(place) < len(h) if least > 10 else len(place)
    chosen = set(place.tolist())
    at = {}
    for i in range(len(first) - 1):
        for s in range(first[i], first[i + 1]):
            for e in range(s + gram, first[i + 1] + 1):
                if n[s:e].sum() >= least:
                    here = {p - s for p in range(s, e) if p in chosen}
                    assert here, "no line of a long enough run is selected"
                    at.setdefault(tuple(h[s:e].tolist()), []).append(here)
    assert all(set.intersection(*x) for x in at.values())
    for o, s, e in zip(owner, a, b):        # a shortest run holds its selected line and lies in its context
        assert s <= place[o] < e and left[o] <= s and e <= right[o]


def test_range_argmin():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 9, 200).astype(np.uint64)
    start = rng.integers(0, 190, 300)
    end = np.minimum(200, start + rng.integers(1, 40, 300))
    want = [int(e - 1 - np.argmin(v[s:e][::-1])) for s, e in zip(start, end)]
    assert range_argmin(v, start, end).tolist() == want


def test_untouched_texts_stay_byte_for_byte(spark):
    df = spark.createDataFrame([(1, " a  b\r\n\n c ", 1), (None, None, 2), (2, "", 3)], "doc_id long, text string, lines int")
    assert [tuple(r)[:3] for r in line_dedup(df).orderBy("lines").collect()] == [(1, " a  b\r\n\n c ", 1), (None, None, 2), (2, "", 3)]
    assert line_dedup(df.limit(0)).collect() == []


@pytest.mark.parametrize("gram,least", [(1, 10), (2, 10), (1, 25)])
def test_default_finds_every_repeated_run_of_enough_words(spark, rng, gram, least):
    pool = [" ".join(rng.choice("abc") + str(rng.randint(0, 5)) for _ in range(rng.choice([1, 2, 4, 9, 12, 30]))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 9])))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, gram=gram, min_words=least) == exact(rows, gram, least)


def test_single_lines_and_runs_behind_a_short_earlier_match(spark):
    long = " ".join(f"w{i}" for i in range(12))
    a, b, c = "a b c", "d e f", "g h i j k"
    rows = [(1, f"x\n{long}\ny"), (2, f"z\n{long}\nv"), (3, long), (4, f"{a}\n{b}\nq"), (5, f"r\n{a}\n{b}\n{c}"),
            (6, f"s\n{a}\n{b}\n{c}\nt")]
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "z\nv", 3: "", 4: rows[3][1], 5: rows[4][1], 6: "s\nt"}
