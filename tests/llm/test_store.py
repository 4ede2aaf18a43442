"""Staged tables and the kernels' slicing."""

import os
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from bidscope.llm import store, textkernels as K


def test_staged_tables_round_trip_and_go(spark):
    df = store.staged(spark.range(10).withColumnRenamed("id", "x"), "probe")
    assert sorted(r[0] for r in df.collect()) == list(range(10))
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    store.drop_staged(df)
    assert not os.path.exists(folder)
    empty = store.staged(spark.range(10).where("id < 0"), "probe")
    assert empty.collect() == [] and empty.columns == ["id"]


def test_a_cluster_must_name_its_shared_folder():
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                           sparkContext=SimpleNamespace(master="spark://m:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_dir(fake)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_slices_cover_sliced_and_null_arrays(kind):
    texts = ["zero", "a b", None, "", "é" * 50, "x" * 200, "tail words here"]
    col = pa.array(texts, kind).slice(1)
    got = []
    for a, b, off, body in K.slices(col, 60, 2):
        assert b - a <= 2
        got += [bytes(body[x:y]).decode() for x, y in zip(off[:-1], off[1:])]
    assert got == [t or "" for t in texts[1:]]
    assert list(K.slices(pa.array([], kind))) == []


def test_word_hashes_follow_the_bytes():
    texts = ["a bb  a", "\tbb\x0bccc\x0c", "a\xa0b \x1cbb"]
    hashes = {}
    for a, b, off, body in K.slices(pa.array(texts), 4):
        h, row, s, e = K.words(body, off)
        for x, y, z in zip(h.tolist(), s, e):
            hashes.setdefault(bytes(body[y:z]), set()).add(x)
    assert sorted(hashes) == sorted({w for t in texts for w in t.encode().split()})
    assert all(len(v) == 1 for v in hashes.values()) and len(set().union(*hashes.values())) == len(hashes)


def test_window_minimum_takes_the_rightmost():
    rng = np.random.default_rng(0)
    for w in (1, 2, 3, 7, 13):
        v = rng.integers(0, 5, 60).astype(np.uint64)
        at = K.window_argmin(v, w)
        for i in range(60 - w + 1):
            assert at[i] == i + w - 1 - int(np.argmin(v[i:i + w][::-1]))
