"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

1. Texts are normalised (white space runs become one space) and cut into chunks
   where the content says so: after ``min_chunk`` characters, at the first
   place whose last three characters lie in a fixed quarter of the code
   points, or at ``max_chunk``.  The same passage is cut alike wherever it
   stands, so copies share chunks.
2. A chunk is known by its 64-bit hash, verified by its SHA-256: the chunk table
   holds one row per distinct (hash, digest) and numbers digests that share a
   hash, so an identifier stands for one content.
3. A document is its recipe, the ordered list of chunk identifiers.  Equal
   recipes are equal texts.  Only hashes and recipes are shuffled, never texts.

Copies are counted by map-side aggregation and results joined back, with join
keys that let Spark split the partition of a large group of copies.

Cases: null text counts as empty, empty texts are equal; of rows with equal text
and equal smallest id (repeated rows) all are marked kept; null ids order
last; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store

SPACES = r"[\x20\x09-\x0D]+"


#: (first code point, end, step, width): of every ``step`` code points ``width`` are in the quarter.
#: Scripts of small blocks alternate closely, those of large ones by ranges.
_QUARTERS = ((0x20, 0x250, 4, 1), (0x250, 0x600, 4, 1), (0x600, 0x2000, 16, 4), (0x2000, 0x10000, 256, 64))


def chunk_pattern(min_chunk: int = 512, max_chunk: int = 4096) -> str:
    """Java pattern of one chunk: content-defined cut, else a forced one or the rest.

    Each script's part of the quarter stands behind a test of its range, so a character is only
    compared with its own.
    """
    parts = []
    for first, end, step, width in _QUARTERS:
        own = "".join(f"\\x{{{c:x}}}" + (f"-\\x{{{c + width - 1:x}}}" if width > 1 else "") for c in range(first + 1, end, step))
        parts.append(own if first == 0x20 else f"[\\x{{{first:x}}}-\\x{{{end - 1:x}}}&&[{own}]]")
    return f"(?s).{{{min_chunk},{max_chunk}}}?(?<=[{''.join(parts)}]{{3}})|.{{1,{max_chunk}}}"


def recipes(docs: DataFrame, id_col: str, text_col: str, min_chunk: int, max_chunk: int) -> DataFrame:
    """(id, text_sha256, row, chunks): hash and digest of each chunk in order, read once."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACES, " ")
    cut = F.regexp_extract_all("norm", F.lit(chunk_pattern(min_chunk, max_chunk)), F.lit(0))
    chunks = F.transform(cut, lambda c: F.struct(F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("d")))
    return (docs.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm"))
                .select("id", F.sha2("norm", 256).alias("text_sha256"),
                        F.monotonically_increasing_id().alias("row"), chunks.alias("chunks")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chunk: int = 512, max_chunk: int = 4096) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, n_chunks."""
    read = store.staged(recipes(docs, id_col, text_col, min_chunk, max_chunk), "chunks")
    pieces = read.select("row", F.posexplode("chunks").alias("pos", "c")).select("row", "pos", "c.h", "c.d")
    table = (pieces.groupBy("h", "d").agg(F.count(F.lit(1)).alias("uses"))
             .groupBy("h").agg(F.sort_array(F.collect_list("d")).alias("ds")))
    ident = (table.select("h", F.posexplode("ds").alias("k", "d"))
             .select(F.col("h").alias("th"), F.col("d").alias("td"), "k"))
    # new columns as join keys: both sides are exchanged, so a hot chunk can be split
    known = (pieces.join(ident.select(F.bitwise_not("th").alias("nh"), "td", "k"),
                         (F.bitwise_not(pieces.h) == F.col("nh")) & (pieces.d == F.col("td")))
             .select("row", F.struct("pos", "h", "k").alias("c")))
    ordered = (known.groupBy("row").agg(F.sort_array(F.collect_list("c")).alias("cs"))
               .select("row", F.transform("cs", lambda c: F.struct(c.h.alias("h"), c.k.alias("k"))).alias("recipe")))
    rows = store.staged(
        read.select("id", "text_sha256", "row").join(ordered, "row", "left")
            .select("id", "text_sha256", F.coalesce("recipe", F.expr("cast(array() as array<struct<h: bigint, k: int>>)"))
                    .alias("recipe")), "recipes")
    store.drop_staged(read)
    last = F.lit((1 << 63) - 1)
    groups = (rows.groupBy("recipe").agg(F.min(F.coalesce("id", last)).alias("low"), F.count(F.lit(1)).alias("group_size"))
              .select(F.xxhash64("recipe").alias("gk"), F.col("recipe").alias("gr"), "low", "group_size"))
    out = rows.withColumn("rk", F.xxhash64("recipe")).join(
        groups, (F.col("rk") == F.col("gk")) & (F.col("recipe") == F.col("gr")))
    return out.select(
        F.col("id").alias(id_col), F.when(F.col("low") != last, F.col("low")).alias("keep_id"),
        "group_size", (F.coalesce("id", last) == F.col("low")).alias("kept"), "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"))
