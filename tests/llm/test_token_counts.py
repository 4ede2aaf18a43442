"""op1 against plain dynamic programming on each pre-token."""

import math

import pytest

from bidscope.llm.packing import byte_ranks
from bidscope.llm.token_counts import token_counts

VOCAB = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def plain(word, ranks):
    best = [(0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - 80), j):
            rank = ranks.get(word[i:j])
            if rank is not None and best[i] is not None:
                got = (best[i][0] - round(math.log(rank + 2) * 1e6), best[i][1] - 1)
                if best[j] is None or got > best[j]:
                    best[j] = got
    return -best[-1][1], best[-1][0]


def test_matches_plain_dynamic_programming(docs, corpus):
    ranks, _ = byte_ranks(VOCAB)
    for longest in (64, 7):
        got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"], r["micro_score"])
               for r in token_counts(docs, VOCAB, longest).collect()}
        for i, t in corpus:
            pre = [b" " + w[k:k + longest] for w in (t or "").encode().split() for k in range(0, len(w), longest)]
            counts = [plain(p, ranks) for p in pre]
            assert got[i] == (len(pre), sum(c for c, _ in counts), sum(s for _, s in counts))


def test_empty_table_repeats_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "the cat", 5, "r"), (1, "the cat", 6, "r"), (None, None, 7, "r")],
                               "doc_id long, text string, n_tokens int, row string")
    got = token_counts(df, VOCAB)
    assert got.columns == ["doc_id", "row", "n_pretokens", "n_tokens", "micro_score"]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got.collect()) == [(0, 0), (1, 2), (1, 2)]
    assert token_counts(df.limit(0), VOCAB).collect() == []
