"""op8 against a dictionary of windows."""

import hashlib
import re

import pytest

from bidscope.llm.substring_dedup import substring_dedup


def brute(rows, k):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - k + 1):
            first.setdefault(tuple(words[i][s:s + k]), (i, s))
    out = {}
    for i, ws in words.items():
        gone = set()
        for s in range(len(ws) - k + 1):
            if first[tuple(ws[s:s + k])] != (i, s):
                gone |= set(range(s, s + k))
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out[i] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("k,gram,mb", [(20, 10, 128), (5, 2, 128), (20, 10, 0.01)])
def test_matches_brute_force(docs, corpus, k, gram, mb):
    got = {r[0]: tuple(r)[1:] for r in substring_dedup(docs, k, gram, mb).collect()}
    assert got == brute(corpus, k)
    assert any(v[1] for v in got.values())


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    t = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(1, t, 9), (1, t, 8), (None, t, 7)], "doc_id long, text string, id int")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup(df).collect())
    assert got == [(0, 0), (1, 30), (1, 30)]


def test_empty_table(docs):
    assert substring_dedup(docs.limit(0)).collect() == []


def _entries(rows, hot=10 ** 9):
    """Batches that the second pass sends for (id, text) rows, every window estimated repeated."""
    import types

    import numpy as np
    import pyarrow as pa

    from bidscope.llm import substring_dedup as S
    maps = [np.full(1 << 15, 255, np.uint8)] * 2
    often = [np.arange(1 << 18, dtype=np.uint64) if hot == 1 else np.zeros(0, np.uint64)] * 2
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()),
                                        pa.array([t for _, t in rows])], names=["id", "sub", "text"])
    return list(S._send_windows(20, 10, types.SimpleNamespace(value=(18, maps, often)))([batch]))


def test_windows_are_told_apart_by_their_whole_hash():
    import numpy as np
    import pyarrow as pa

    from bidscope.llm.substring_dedup import _settle
    (sent,) = _entries([(1, " ".join(map(str, range(60))))])
    assert all(len(r["wins"]) == 8 * r["n"] for r in sent.to_pylist())
    wins = [np.array([x], np.uint64).tobytes() for x in (7 << 48 | 5, 9 << 48 | 5, 7 << 48 | 5)]    # alike in 48 bits
    entries = pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in ([1, 2, 3], [0] * 3, [0] * 3, [1] * 3, [4] * 3)),
                                          pa.array(wins, pa.binary())], names=["id", "sub", "start", "n", "rep", "wins"])
    assert [r["id"] for out in _settle([entries]) for r in out.to_pylist()] == [3]


def test_windows_around_a_hot_phrase_spread(spark, rng):
    phrase = " ".join(f"p{i}" for i in range(10))
    rows = [(i, " ".join(f"a{i}_{j}" for j in range(12)) + f" {phrase} " + " ".join(f"b{i % 7}_{j}" for j in range(12)))
            for i in range(60)]
    groups = [r["rep"] for b in _entries(rows, hot=1) for r in b.to_pylist() if r["wins"]]
    assert len(groups) == len(set(groups))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for hot in (1, 8, 10 ** 9):
        assert {r[0]: tuple(r)[1:] for r in substring_dedup(df, hot=hot).collect()} == brute(rows, 20)


def test_a_full_sketch_changes_nothing_but_the_route(spark, corpus, docs, monkeypatch):
    """So few cells that nearly all count as repeated: the same result, and a bounded list of often seen cells."""
    from bidscope.llm import store, substring_dedup as module
    want = {r[0]: tuple(r)[1:] for r in substring_dedup(docs).collect()}
    monkeypatch.setattr(module, "_BLOCK_BITS", 8)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup(docs, max_sketch_mb=0).collect()} == want == brute(corpus, 20)
    texts = store.keyed(docs)
    n_bytes = sum(len((t or "").encode()) for _, t in corpus)
    bits, maps, often = module.repeat_sketch(texts, 20, 10, 0, 1, n_bytes)
    assert bits == 8 and sum(bin(int(x)).count("1") for x in maps[0]) > 200
    assert all(len(x) <= 256 for x in often)
    monkeypatch.setattr(module, "_ABOVE_MEAN", 4)
    assert all(len(x) <= 64 for x in module.repeat_sketch(texts, 20, 10, 0, 1, n_bytes)[2])
