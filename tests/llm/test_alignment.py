"""op13: links, groups and counts equal a plain alignment; the hash is minimal and perfect."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bidscope.llm import alignment as A
from bidscope.llm.catalog import vocabulary

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(FIRST))
    t.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}
    s = sentencepiece.SentencePieceProcessor(model_file=vocabulary(SECOND))

    def first(text):
        e = t.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(byte[c] for c in t.id_to_token(i))) for i in e.ids]

    def second(text):
        out = []
        for i in s.encode(text):
            p = s.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        return out
    return first, second


def brute(rows, sides):
    links, shapes = [], []
    for i, text in rows:
        a, b = (side(text) for side in sides) if text else ([], [])
        want = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a = b = []
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for k, x in tokens:
                own.append((k, at, at + len(x)))
                at += len(x)
            spans.append(own)
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, s = [], 0
        for e in common:
            groups.append("|".join(",".join(str(k) for k, x, y in own if s <= x and y <= e) for own in spans))
            s = e
        own, j = [], 0
        for k, x, y in spans[0]:
            while j < len(spans[1]) and spans[1][j][2] <= x:
                j += 1
            m = j
            while m < len(spans[1]) and spans[1][m][1] < y:
                own.append((k, spans[1][m][0]))
                m += 1
        links.append(own)
        shapes.append((i, len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = Counter(p for own in links for p in set(own))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return Counter((*shape[:5], sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own), shape[5])
                   for shape, own in zip(shapes, links))


def found(docs, **how):
    return Counter(tuple(r) for r in A.align_tokenizers(docs, vocabulary(FIRST), vocabulary(SECOND), **how).collect())


@pytest.fixture
def rows(corpus, rng):
    odd = ["<|endoftext|> and <s> </s> <unk> <0x41>", "▁ block", "a  b   c \n\n d ", " ", "\n", "漢字かな交じり文 – “quoted” … 😀😀", "é ​ ﻿",
           "x" * 20_000, "word " * 8_000, "\x00\x01\x7f", "ﬁ ½ Ⅷ", "don't we're I'll 123456 $$$"]
    return [*corpus, *((5000 + k, t) for k, t in enumerate(odd)), (None, "null id"), (None, "other null id"), (1, "again"), (1, "again")]


@pytest.mark.parametrize("max_table_mb", [192, 0.002])
def test_equals_plain_alignment(spark, rows, sides, max_table_mb):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(docs, max_table_mb=max_table_mb) == brute(rows, sides)


def test_extra_columns_and_empty_table(spark, rows, sides):
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows[:20]], "doc_id long, text string, row int, pair int, a string")
    assert found(docs) == brute(rows[:20], sides)
    assert found(docs.where("false")) == Counter()
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(none) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


@pytest.mark.parametrize("n, shards", [(0, 1), (1, 1), (50_000, 3), (2_000, 40)])
def test_numbers_are_minimal_and_perfect(n, shards):
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 48, n))
    of = A.shard_of(keys, shards)
    rows = []
    for s in np.unique(of).tolist():
        sizes, words = A.hash_levels(keys[of == s])
        rows.append({"shard": s, "sizes": np.array(sizes, np.int64).tobytes(), "words": words.tobytes()})
    number = A.Numbering.of(rows, shards)
    assert len(number) == len(keys)
    assert sorted(number(keys).tolist()) == list(range(len(keys)))
    assert number(keys + (1 << 50)).max(initial=-1) < max(1, len(keys))


def test_tree_sums(spark):
    from bidscope.llm import sums

    def vectors(batches):
        from pyspark import TaskContext
        total = np.zeros(40_000, np.int64)
        for b in batches:
            np.add.at(total, b.column(0).to_numpy() % 40_000, 1)
        yield from sums.dense_rows(total, TaskContext.get().partitionId())

    ids = spark.range(0, 100_000, 1, 300)
    got = sums.tree_summed(ids.mapInArrow(vectors, sums.DENSE), 40_000)
    assert got.tolist() == [3 if i < 20_000 else 2 for i in range(40_000)]
    assert sums.tree_summed(ids.where("false").mapInArrow(vectors, sums.DENSE), 5).tolist() == [0] * 5


def test_first_side_switches_libraries_where_tables_agree():
    """Below U+2000 both libraries give the same ids; from there on only one is used."""
    side = A.ByteLevel(vocabulary(FIRST))
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(FIRST))
    t.encode_special_tokens = True
    texts = [c.join(around) for c in map(chr, range(1, 0x2000)) for around in (("", ""), ("a", "b"), (" ", "1"), ("\n", " "))]
    for text, want in zip(texts, t.encode_batch([" " + x for x in texts], add_special_tokens=False)):
        assert side(text) == want.ids, ascii(text)
