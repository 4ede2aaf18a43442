"""op6 against a dictionary of normalised texts."""

import hashlib
import re

import pytest

from bidscope.llm.exact_dedup import chunk_pattern, exact_dedup


def test_matches_brute_force(docs, corpus):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in corpus}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    want = {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())
            for i, t in norm.items()}
    for sizes in ((512, 4096), (8, 32)):
        got = {r[0]: tuple(r)[1:5] for r in exact_dedup(docs, min_chunk=sizes[0], max_chunk=sizes[1]).collect()}
        assert got == want
    assert any(v[1] > 1 for v in want.values())


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnop qrstuvwxyz", "".join(map(chr, range(0x430, 0x450))) + " ",
                                      "".join(map(chr, range(0x3b1, 0x3ca))) + " ", "".join(map(chr, range(0x627, 0x64b))) + " ",
                                      "".join(map(chr, range(0x905, 0x93a))) + " ", "".join(map(chr, range(0x4e00, 0x9fff, 7)))])
def test_chunks_follow_content(spark, alphabet):
    """A text that starts elsewhere is cut alike, in every script."""
    import random
    from pyspark.sql import functions as F
    rng = random.Random(3)
    body = "".join(rng.choice(alphabet) for _ in range(20000))
    df = spark.createDataFrame([(body,), ("shifted start " + body,)], "t string")
    a, b = (r[0] for r in df.select(F.regexp_extract_all("t", F.lit(chunk_pattern(64, 1024)), F.lit(0))).collect())
    assert "".join(a) == body and "".join(b) == "shifted start " + body
    assert len(set(a) & set(b)) > 0.9 * len(a) > 50


def test_nulls_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (None, None), (5, "")],
                               "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(df).collect())
    assert got == [(-1, 1, 3, False), (-1, 5, 2, False), (1, 1, 3, True), (1, 1, 3, True), (5, 5, 2, True)]
    assert exact_dedup(df.limit(0)).collect() == []
