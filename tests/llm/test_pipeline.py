"""The pipeline against a plain version of every stage, on sf0.001."""

import corpus_pipeline as P
from bidscope.llm.catalog import fold
from bidscope.llm.quality import score_quality
from test_decontaminate import words
from test_line_dedup import exact as exact_lines
from test_near_dedup import brute as brute_near
from test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]


def test_run_equals_the_plain_version(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    score = {r["doc_id"]: r["score"] for r in score_quality(docs.select("doc_id", "text"), labels, fold(5) != 0).collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if score[r["doc_id"]] >= P.LEAST_QUALITY]
    assert len({i for i, _ in rows} & bad) <= 0.2 * len(bad) and len(rows) > 0.8 * (len(score) - len(bad))
    cut = exact_lines(rows, 1, 10)

    def without(i, text):
        kept, out = list(cut[i][2]), []
        for part in (text or "").encode().split(b"\n"):
            if part.strip():
                if not kept or tuple(part.split()) != kept[0]:
                    continue
                kept.pop(0)
            out.append(part)
        return b"\n".join(out).decode()

    rows = [(i, without(i, t)) for i, t in rows]
    classes = brute_near(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    items = [" ".join(words(r["text"])) for r in bench.collect()]
    rows = [(i, t) for i, t in rows if not any(f" {x} " in f" {' '.join(words(t))} " for x in items)]
    got = P.run(spark, SF).collect()
    n, least = check(got, rows, 2048)
    assert n <= least * 1.1 + 2


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        assert out.collect() == []


def test_rows_without_id_and_of_one_id_with_different_texts_stay(spark):
    import random

    from bidscope.llm.line_dedup import line_dedup
    from bidscope.llm.substring_dedup import substring_dedup
    from llm_fixtures import prose
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    docs = spark.createDataFrame([(None, a), (None, b), (7, c), (7, d), (8, c), (8, c)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in P.near(spark, docs, SF).collect()))
    assert got == sorted([(0, a), (0, b), (7, c), (7, d)])
    rows = spark.createDataFrame([(None, f"{a}\nx"), (None, f"y\n{b}"), (7, c), (7, d), (8, f"{c}\n{d}\nz")],
                                 "doc_id long, text string")
    assert sorted(r["text"] for r in line_dedup(rows).collect()) == sorted([f"{a}\nx", f"y\n{b}", c, d, "z"])
    cut = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup(rows).collect())
    assert cut == [(0, 61, 0), (0, 61, 0), (7, 60, 0), (7, 60, 0), (8, 121, 120)]
