"""Tables staged between steps, in the folder that all executors share.

A staged table cuts the lineage: later steps read files instead of
recomputing, and a lost executor costs only its running tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators (ids are longs above this value).
NULL_ID = -(1 << 63)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may leave it unset (tests).

    Off local mode a missing setting raises: a machine-local folder would
    not be seen by the other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    import tempfile
    path = tempfile.mkdtemp(prefix="bidscope-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    The files are removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/bidscope-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Remove the files of staged tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/bidscope-" in folder:
                jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
                jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def size_of(staged: DataFrame) -> int:
    """Bytes of the files of a staged table."""
    spark, total = staged.sparkSession, 0
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
        total += jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jpath).getLength()
    return total


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) only: null ids as ``NULL_ID``, null texts as empty."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def document_key(id_col: str = "id", text_col: str = "text"):
    """(id, sub): equal for rows that repeat an id and its text; ``sub`` is the text's
    hash, so rows of one id, or without id, with different texts stay apart."""
    return F.struct(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                    F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("sub"))


def unkeyed(col: str = "id"):
    """The id as given: null again where it was null."""
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


def packed(docs: DataFrame, drop=(), name: str = "row"):
    """All columns but ``drop`` as one struct, so that no name can clash with an
    operator's own."""
    rest = [c for c in docs.columns if c not in drop]
    return (F.struct(*[docs[c] for c in rest]) if rest else F.struct(F.lit(None).alias("none"))).alias(name), rest
