"""op11: words, near words, forms and roots equal a brute-force version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bidscope.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, thin=199, least_length=6, least_n=5, ratio=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if thin and h % thin == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_n}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def found(docs, **how):
    rows = S.spelling_variants(docs, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


def variants(rng, n_docs=160):
    words = ["letter", "Lettre", "letters", "leters", "éclairé", "éclaire", "ÀÀÀÀÀÀ", "ààààà", "straße", "strasse",
             "abcdefgh", "abcdefg", "bcdefgh", "abcdefghi", "ÿÿÿÿÿÿ", "÷×÷×÷×", "aaaaaaa", "aaaaaaaa", "aaaaaa",
             "q" * 70, "q" * 71, "q" * 69 + "r", "short"]
    rows = []
    for i in range(n_docs):
        ws = rng.choices(words, weights=[3 ** (len(words) - k) % 97 + 1 for k in range(len(words))], k=rng.randint(0, 60))
        rows.append((i, rng.choice([" ", ", ", "1", "\n"]).join(ws)))
    # A chain of forms, each five times as frequent as the one before.
    rows += [(1000 + k, " ".join(["chainaaa"] * 5 + ["chainaab"] * 40 + ["chainabb"] * 400 + ["chainbbb"] * 4000)) for k in range(3)]
    return rows + [(5, None), (None, "letter letter leters"), (None, "lettex " * 7), (6, ""), (7, "letter " * 3000), (7, "letter " * 3000)]


@pytest.mark.parametrize("thin, max_filter_mb", [(199, 32), (3, 32), (7, 1e-4)])
def test_equals_brute_force(spark, rng, thin, max_filter_mb):
    rows = variants(rng)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, thin)
    assert any(r[2] != (r[1] or r[0]) for r in want)       # some root lies behind the form
    assert found(docs, thin=thin, max_filter_mb=max_filter_mb) == want


def test_extra_columns_and_empty_table(spark, rng):
    rows = variants(rng, 40)
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, word int, edit string, n int")
    assert found(docs) == brute(rows)
    assert found(docs.where("false")) == set()
    assert found(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")) == set()


def test_string_ids(spark):
    rows = [(f"é{i}", "wording wordingg " * 3) for i in range(30)]
    assert found(spark.createDataFrame(rows, "doc_id string, text string"), thin=5) == brute(rows, 5)


def test_crc_of_spans(rng):
    texts = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    seeds = np.array([zlib.crc32(b"%d:" % i) for i in range(50)], np.uint32)
    got = S.crcs(seeds, np.frombuffer(b"".join(texts), np.uint8), starts, ends, S.crc_table())
    assert got.tolist() == [zlib.crc32(b"%d:" % i + t) for i, t in enumerate(texts)]


def test_rounds_keep_the_bound():
    blocks, rounds = S.plan_rounds({6: 1000, 7: 10, 8: 4000, 64: 1}, 300)
    assert all(sum(b - a for _, a, b in r) <= 300 for r in rounds)
    for shard, n in blocks.items():
        parts = sorted((a, b) for r in rounds for s, a, b in r if s == shard)
        assert parts[0][0] == 0 and parts[-1][1] == n and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
