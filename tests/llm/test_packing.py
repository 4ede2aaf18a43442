"""op4: ids equal to ``tokenizers``, exact placement, few sequences."""

import zlib

import numpy as np
import pytest

from bidscope.llm.packing import Encoder, best_fit, byte_ranks, pack

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids(texts):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(VOCAB)
    return [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]


def check(rows, docs, capacity):
    ids = dict(zip((i for i, _ in docs), ([*x, 0] for x in reference_ids([t or "" for _, t in docs]))))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        ps.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in ps] == list(range(len(ps)))
        at = 0
        for p in ps:
            assert p["start"] == at
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[d][p["start"]:at], "<u4").tobytes())
        assert at == len(ids[d])
        assert len(ps) == -(-at // capacity) and all(p["length"] == capacity for p in ps[1:])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    total = sum(map(len, ids.values()))
    return len(by_seq), -(-total // capacity)


@pytest.mark.parametrize("capacity,per_task", [(2048, 1 << 17), (128, 40), (64, 10)])
def test_pieces_and_placement(docs, corpus, capacity, per_task):
    rows = pack(docs, VOCAB, capacity, rows_per_task=per_task).collect()
    n, least = check(rows, corpus, capacity)
    assert n <= least * 1.12 + 2


def test_encoder_equals_tokenizers():
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist()
    texts += ["", " ", "\n\n  x", "a<|endoftext|>b", "汉字 emoji 🙂 “quotes” don't", "a" * 5000, "it's we'll  x"]
    enc = Encoder(VOCAB)
    assert [list(enc(t.encode())) for t in texts] == reference_ids(texts)


def test_ranks_are_the_whole_vocabulary():
    ranks, special = byte_ranks(VOCAB)
    assert len(ranks) + len(special) == 50257 and all(bytes([b]) in ranks for b in range(256))


def test_best_fit_takes_the_tightest_bin():
    where, offset, fill = best_fit([7, 5, 3, 5], 10)
    assert (where, offset, fill) == ([0, 1, 0, 1], [0, 0, 7, 5], [10, 10])


def test_repeated_rows_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, None)], "doc_id long, text string")
    rows = pack(df, VOCAB).collect()
    assert len(rows) == 3 and len({r["offset"] for r in rows}) == 3
    assert pack(df.limit(0), VOCAB).collect() == []
