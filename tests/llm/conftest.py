import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import prose  # noqa: E402


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def corpus(rng):
    """Texts with exact and near copies, shared passages, odd spaces, empty and null ones."""
    base = [prose(rng, rng.randint(1, 300)) for _ in range(60)]
    passage = prose(rng, 55)
    texts = []
    for i, t in enumerate(base):
        texts.append(t)
        if i % 7 == 0:
            texts.append(t)
        if i % 5 == 0:
            ws = t.split()
            ws[len(ws) // 2] = "CHANGED"
            texts.append(" \t".join(ws))
        if i % 6 == 0:
            texts.append(t[:len(t) // 2] + " " + passage + "\n" + t[len(t) // 2:])
    texts += ["", None, " \n\t ", "a", "a " * 500, "ab\x0bcd\x0cef\x1cgh\xa0ij", passage, "é" * 3000,
              (prose(rng, 40) + "\n") * 5]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in corpus],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
