"""Every operator and pipeline stage on odd input: columns named like an operator's own, nulls, empty and
very long texts, ties, repeated rows, rows of one id, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from bidscope.llm import alignment, decontaminate, exact_dedup, langid, line_dedup, near_dedup, packing, quality, spelling
from bidscope.llm import substring_dedup, token_counts, toxicity
from bidscope.llm.catalog import fold, vocabulary
from llm_fixtures import prose

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside.
CLASHES = ("id", "key", "row", "rows", "sub", "n", "start", "starts", "ns", "place", "size", "rep", "class", "comp", "fp", "band",
           "bands", "bucket", "hub", "h", "k", "a", "b", "u", "v", "d", "d1", "d2", "unit", "piece", "offset", "word", "form", "near", "edit",
           "block", "part", "data", "pair", "tokens", "chunks", "recipe", "norm", "low", "cut", "runs", "context", "_id", "_y", "_text", "_p",
           "_doc", "_kept", "_hit", "vec", "y", "at", "score", "share", "l", "least", "before", "bytes", "n_words", "n_lines",
           "lang_pred", "item_id", "cosine", "kept", "class_id", "n_tokens", "sequence_id")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    shared = prose(rng, 60)
    long_lines = "\n".join(prose(rng, 12) for _ in range(900)) + "\n" + shared + "\n" + "\n".join(prose(rng, 12) for _ in range(900))
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(25)]
    texts += [f"{texts[0]}\n{shared}", f"{shared}\n{texts[1]}", texts[2], texts[2], "", " \n\t ", "x" * 60_000, long_lines, long_lines + " end"]
    out = [(i * 2 + 1, t) for i, t in enumerate(texts)]
    return out + [(None, texts[3]), (None, prose(rng, 40)), (500, None), (500, prose(rng, 30)), (501, texts[4]), (501, texts[4]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def clashing(df):
    """``df`` with columns of all the names, of various kinds, nulls in some."""
    kinds = [F.lit("other"), F.lit(7), F.lit(None).cast("double"), F.lit(True), F.array(F.lit(1))]
    return df.withColumns({c: kinds[i % len(kinds)] for i, c in enumerate(CLASHES) if c not in df.columns})


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def benchmark(spark, rows):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    own = " ".join(rows[10][1].split()[:25])
    return items.unionByName(spark.createDataFrame([(9001, own), (9002, None), (9003, ""), (None, own)], items.schema))


OPERATORS = {
    "op1": lambda s, d, r: token_counts.token_counts(d, vocabulary()).select("doc_id", "n_pretokens", "n_tokens", "micro_score"),
    "op2": lambda s, d, r: decontaminate.contaminated(d, benchmark(s, r)).select("doc_id", "item_id", "place", "lcs"),
    "op3": lambda s, d, r: line_dedup.line_dedup(d).select("doc_id", "text", "n_lines", "n_removed"),
    "op4": lambda s, d, r: packing.pack(d, vocabulary(), 256).select("doc_id", "piece", "start", "length", "ids_crc32"),
    "op6": lambda s, d, r: exact_dedup.exact_dedup(d).select("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    "op7": lambda s, d, r: near_dedup.near_dedup(d),
    "op8": lambda s, d, r: substring_dedup.substring_dedup(d),
    "op9": lambda s, d, r: quality.score_quality(d, labels(s), fold(5) != 0).select("doc_id", F.round("score", 6)),
    "op10": lambda s, d, r: toxicity.score_toxicity(d, labels(s), fold(3) != 1).select("doc_id", F.round("score", 6)),
    "op11": lambda s, d, r: spelling.spelling_variants(d, least_length=2, least_n=2).select("word", "form", "root", "n", "n_near", "form_n"),
    "op12": lambda s, d, r: langid.identify_language(d, fold(5) != 0),
    "op13": lambda s, d, r: alignment.align_tokenizers(d, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")),
}
#: These return one row per row of their input.
PER_ROW = ("op1", "op3", "op6", "op7", "op8", "op9", "op10", "op12", "op13")


def plain(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_named_like_the_operators_own_change_nothing(spark, docs, rows, name):
    run = OPERATORS[name]
    want = plain(run(spark, docs, rows))
    assert plain(run(spark, clashing(docs), rows)) == want
    if name in PER_ROW:
        assert len(want) == len(rows)
    assert run(spark, docs.where("false"), rows).collect() == []


@pytest.mark.parametrize("name", ["op3", "op9", "op10", "op1"])
def test_other_columns_stay(spark, docs, name):
    df = clashing(docs)
    out = {"op3": lambda: line_dedup.line_dedup(df), "op9": lambda: quality.score_quality(df, labels(spark), fold(5) != 0),
           "op10": lambda: toxicity.score_toxicity(df, labels(spark), fold(3) != 1), "op1": lambda: token_counts.token_counts(df, vocabulary())}[name]()
    new = {"op3": {"n_lines", "n_removed"}, "op9": {"score"}, "op10": {"score"}, "op1": {"n_pretokens", "n_tokens", "micro_score"}}[name]
    assert set(df.columns) - {"text"} - new <= set(out.columns)
    assert out.where("key = 7 and id = 'other'").count() == docs.count()


@pytest.mark.parametrize("stage", [name for name, _ in P.STAGES])
def test_stages_take_odd_rows_and_columns(spark, docs, stage):
    """Between 1 and all documents stay; the columns are those of the input."""
    df = clashing(docs)
    out = dict(P.STAGES)[stage](spark, df, SF)
    if stage == "best_fit_packing":
        assert out.agg(F.count_distinct("sequence_id")).first()[0] > 0
        return
    assert out.columns == df.columns
    got = out.select("doc_id", "text", "_doc", "_kept", "class", "row").collect()
    assert 0 < len(got) <= docs.count()
    if stage in ("near_dedup", "decontamination"):
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        assert {(r["doc_id"], r["text"]) for r in got} <= before
    if stage == "near_dedup":                      # the rows without id and of one id that differ stay apart
        assert sum(r["doc_id"] == 500 for r in got) == 1 and sum(r["doc_id"] == 501 for r in got) == 0
