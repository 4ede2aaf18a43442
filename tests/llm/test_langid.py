"""op12: phrases equal a substring search, held-out languages are found."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from bidscope.llm import langid as L
from bidscope.llm import textkernels as K

SYLLABLES = {"xa": ["ka", "lo", "mi", "tor", "sha"], "yb": ["été", "que", "ou", "ien", "la"], "zc": ["ж", "ло", "ми", "ер", "ста"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def fold(text):
    off, body = L.folded(*K.buffers(pc.utf8_lower(pa.array([text or ""], pa.large_string()))))
    return body.tobytes()


def phrases(text, reference, block=None):
    """Greedy phrases of ``text`` by plain substring search, block by block."""
    count, occurs = 0, 0.0
    for s in range(0, len(text), block or L._BLOCK):
        part, i = text[s:s + (block or L._BLOCK)], 0
        while i < len(part):
            j = i
            while j < len(part) and part[i:j + 1] in reference:
                j += 1
            count += 1
            if j > i:
                here = sum(reference.startswith(part[i:j], k) for k in range(len(reference)))
                occurs += np.log2(here + 1)
            i = max(j, i + 1)
    return count, occurs


def model(references):
    rows = []
    for lang, text in references.items():
        keys, targets, occurs = L.suffix_automaton(text)
        rows.append({"lang": lang, "size": len(text), "keys": keys.tobytes(), "targets": targets.tobytes(), "occurs": occurs.tobytes()})
    return L.Automata.of(rows, {x: 1 for x in references})


@pytest.mark.parametrize("block", [1024, 16])
def test_phrases_equal_substring_search(rng, monkeypatch, block):
    monkeypatch.setattr(L, "_BLOCK", block)
    references = {x: fold(speak(rng, x, 150)) for x in SYLLABLES}
    m = model(references)
    texts = [speak(rng, rng.choice(list(SYLLABLES)), rng.randint(0, 30)) for _ in range(40)] + ["", "ω ж", "!?", "a" * 3000]
    off, body = L.folded(*K.buffers(pc.utf8_lower(pa.array(texts, pa.large_string()))))
    count, often = m.parse(off, body)
    for r, text in enumerate(texts):
        for k, lang in enumerate(m.langs):
            n, occurs = phrases(fold(text), references[lang], block)
            assert count[r, k] == n, (text, lang)
            assert often[r, k] == pytest.approx(occurs, rel=1e-4)


def test_many_symbols(rng):
    """More than 64 byte classes: bit sets of several words."""
    references = {"a": bytes(rng.randrange(256) for _ in range(4000)), "b": bytes(rng.randrange(200, 256) for _ in range(900))}
    m = model(references)
    text = bytes(rng.randrange(256) for _ in range(700)) + references["a"][100:160]
    count, _ = m.parse(np.array([0, len(text)]), np.frombuffer(text, np.uint8))
    assert [int(c) for c in count[0]] == [phrases(text, references[x])[0] for x in m.langs]


def test_folding():
    assert fold("Ab-- 12 Çd\n") == "ab çd ".encode()
    off, body = L.folded(np.array([0, 3, 3, 6]), np.frombuffer(b"A  b- c"[:6].lower(), np.uint8))
    assert off.tolist() == [0, 2, 2, 4] and body.tobytes() == b"a b "


def corpus(rng, n=240):
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, speak(rng, lang, rng.randint(3, 60)), lang))
    return rows


def predicted(docs, learnable=None, **how):
    learnable = F.col("doc_id") % 5 != 0 if learnable is None else learnable
    return {r["doc_id"]: r for r in L.identify_language(docs, learnable, **how).collect()}


def test_held_out_languages(spark, rng):
    rows = corpus(rng)
    got = predicted(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), reference_bytes=4096)
    assert len(got) == len(rows)
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows if i % 5 == 0)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_labels_and_ids_teach_nothing(spark, rng):
    rows = corpus(rng, 120)
    other = [(i, t, "xa" if i % 5 == 0 else lang) for i, t, lang in rows]
    a, b = (predicted(spark.createDataFrame(x, "doc_id long, text string, lang string")) for x in (rows, other))
    assert {i: tuple(r) for i, r in a.items()} == {i: tuple(r) for i, r in b.items()}


def test_cases(spark, rng):
    rows = [*corpus(rng, 60), (1001, None, "xa"), (1002, "", None), (1003, "12 !?", "yb"), (1004, speak(rng, "zc", 30_000), None),
            (None, speak(rng, "yb", 40), "yb"), (1005, "…", "xa"), (1006, "漢字", None)]
    docs = spark.createDataFrame([(*r, "s", 0.5, 3) for r in rows],
                                 "doc_id long, text string, lang string, lang_pred string, score double, n_phrases int")
    got = predicted(docs)
    assert len(got) == len(rows)
    for i in (1001, 1002, 1003, 1005):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[1004]["lang_pred"] == "zc" and got[None]["lang_pred"] == "yb" and got[1006]["lang_pred"] in SYLLABLES
    nothing = predicted(docs, F.lit(False))
    assert {r["lang_pred"] for r in nothing.values()} == {"und"}
    assert predicted(docs.where("false")) == {}
    one = predicted(docs, F.col("lang") == "xa")
    assert one[1004]["lang_pred"] == "xa" and one[1004]["score"] == 1.0


def test_reference_is_bounded(spark, rng):
    docs = spark.createDataFrame([(i, speak(rng, "xa", 400), "xa") for i in range(200)] + [(900, speak(rng, "yb", 9000), "yb")],
                                 "doc_id long, text string, lang string")
    m = L.learn(docs, reference_bytes=2048)
    assert sorted(m.langs) == ["xa", "yb"] and (m.log_size <= np.log2(2050)).all() and (m.log_size > 10.5).all()
