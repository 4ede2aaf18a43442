"""Tables that micro-batches write exactly once.

``EpochTable`` keeps a folder per epoch and a manifest (``sources.manifests``) that lists the
folders of the current state.  An epoch is written first and committed by the manifest
after; so a crash between the two leaves files that no reader sees and that the replayed
epoch replaces, and an epoch that is committed is skipped when it comes again.

With keys the table is an upsert: a key's newest epoch holds its row.  Only the rows of a
batch are written; every ``compact_every`` epochs the folders become one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidscope.sources.manifests import ManifestLog


class EpochTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str] = (), compact_every: int = 16):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.compact_every = list(keys), compact_every
        self.log = ManifestLog(spark, f"{self.root}/_manifests")

    def _state(self) -> tuple[int, list[tuple[int, str]]]:
        """(last epoch committed, -1 when none; (epoch, folder) of the state)."""
        lines = self.log.read()
        return (int(lines[0]), [(int(e), f) for e, f in (x.split(" ", 1) for x in lines[1:])]) if lines else (-1, [])

    def last_epoch(self) -> int:
        return self._state()[0]

    def read(self) -> DataFrame:
        """The committed state: every row, or with keys the newest row of each key."""
        return self._merged(self._state()[1])

    def _merged(self, folders: list[tuple[int, str]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        parts = None
        for epoch, folder in folders:
            part = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}").withColumn("_epoch", F.lit(epoch))
            parts = part if parts is None else parts.unionByName(part)
        if not self.keys:
            return parts.drop("_epoch")
        values = [c for c in self.schema.names if c not in self.keys]
        newest = parts.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_epoch").alias("_row"))
        return newest.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in self.schema.names])

    def write(self, batch: DataFrame, epoch: int) -> bool:
        """Write and commit an epoch; False if it was committed before."""
        last, folders = self._state()
        if epoch <= last:
            return False
        folder = f"epoch={epoch}-{uuid.uuid4().hex[:8]}"
        batch.select(*self.schema.names).write.parquet(f"{self.root}/{folder}")
        folders = [*folders, (epoch, folder)]
        if self.keys and len(folders) > self.compact_every:
            whole = f"to={epoch}-{uuid.uuid4().hex[:8]}"
            self._merged(folders).write.parquet(f"{self.root}/{whole}")
            folders = [(epoch, whole)]

        def change(lines: list[str]) -> list[str] | None:
            if lines and int(lines[0]) >= epoch:
                return None
            return [str(epoch), *(f"{e} {f}" for e, f in folders)]

        return self.log.update(change)

    def sweep(self) -> None:
        """Remove the folders that the state does not list (crashed epochs, compacted ones)."""
        used = {f for _, f in self._state()[1]}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(("epoch=", "to=")) and name not in used:
                fs.delete(status.getPath(), True)
