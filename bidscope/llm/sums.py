"""Sums of arrays over all tasks, added up by Spark in blocks, as a tree.

Each task sends its array once, cut into blocks.  A round adds the blocks of
neighbouring tasks, and rounds follow until one block of each number is left; the
driver receives only the finished sum.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store

PARTS = "block int, data binary"
_BLOCK = 1 << 14


def part_rows(total: np.ndarray):
    """A task's array as an Arrow batch of blocks."""
    import pyarrow as pa
    flat = np.ascontiguousarray(total).ravel()
    cut = [flat[i:i + _BLOCK].tobytes() for i in range(0, len(flat), _BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())],
                                      names=["block", "data"])


def summed(parts: DataFrame, shape: tuple[int, ...], dtype: str = "float64") -> np.ndarray:
    """The sum of all tasks' arrays (zeros when no task sent one), added as a tree."""
    rows = parts.withColumn("part", F.spark_partition_id()).select("block", "part", "data")
    return tree_summed(rows, int(np.prod(shape)), dtype).reshape(shape)


# ---- dense vectors of counts, added as a tree ------------------------------------------------

DENSE = "block int, part int, data binary"
_FAN_IN = 16


def _dense_batch(rows: list):
    import pyarrow as pa
    block, part, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(part, pa.int32()), pa.array(data, pa.binary())],
                                      names=["block", "part", "data"])


def dense_rows(total: np.ndarray, part: int):
    """Task ``part``'s vector in Arrow batches of blocks; blocks of zeros are left out."""
    rows = []
    for b, i in enumerate(range(0, len(total), _BLOCK)):
        cut = total[i:i + _BLOCK]
        if cut.any():
            rows.append((b, part, cut.tobytes()))
        if len(rows) == 64:
            yield _dense_batch(rows)
            rows = []
    if rows:
        yield _dense_batch(rows)


def _add_parts(dtype: str):
    """Rows sorted by (block, part) -> one row for each."""
    def run(batches):
        key, total = None, None
        for batch in batches:
            for block, part, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                x = np.frombuffer(data, dtype)
                if (block, part) == key:
                    total += x
                    continue
                if key is not None:
                    yield _dense_batch([(*key, total.tobytes())])
                key, total = (block, part), x.copy()
        if key is not None:
            yield _dense_batch([(*key, total.tobytes())])
    return run


def tree_summed(vectors: DataFrame, length: int, dtype: str = "int64", parts: int | None = None) -> np.ndarray:
    """The sum of all vectors (zeros where none was sent), of ``parts`` parts (one a task by default).

    Each round adds the blocks of ``_FAN_IN`` neighbouring parts, so that no task reads
    more than that of one block, however many tasks there were.
    """
    spark = vectors.sparkSession
    parts, tasks, rows = parts or vectors.rdd.getNumPartitions(), store.shuffle_partitions(spark), vectors
    while True:
        parts = -(-parts // _FAN_IN)
        # neighbours are added in the order of their parts, so sums are the same in every run
        rows = (rows.withColumn("sub", F.col("part")).withColumn("part", F.expr(f"part div {_FAN_IN}").cast("int"))
                    .repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "sub")
                    .select("block", "part", "data").mapInArrow(_add_parts(dtype), DENSE))
        if parts <= 1:
            break
    out = np.zeros(length, dtype)
    for r in rows.collect():
        x = np.frombuffer(r["data"], dtype)
        out[r["block"] * _BLOCK:r["block"] * _BLOCK + len(x)] = x
    return out
