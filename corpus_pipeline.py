"""Training-corpus pipeline: raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), reads all that the stage before kept and
returns the columns of ``documents``; the last returns the packed pieces.  Between
stages the rows are written as Parquet into the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm import store
from bidscope.llm.catalog import fold, table, vocabulary
from bidscope.llm.decontaminate import clean_documents, contaminated
from bidscope.llm.line_dedup import line_dedup
from bidscope.llm.near_dedup import drop_near_duplicates
from bidscope.llm.packing import pack
from bidscope.llm.quality import score_quality

#: Documents whose share of good neighbours is below this go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote accepts."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"), fold(5) != 0, keep_text=True)
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier document has."""
    out = line_dedup(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack(docs, vocabulary(), capacity=2048, separator=0)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store.staged(docs, name)
            if i:
                store.drop_staged(before)
    return docs


#: Classifier, signatures, latent search and tokens are not for SQL; see the tests.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
