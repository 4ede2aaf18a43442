"""Best-fit packing by hierarchical residual rounds.

1. Every text becomes token ids and one separator id; longer documents are cut
   into pieces of ``capacity`` tokens of which the first may be shorter.
2. Round 0 deals pieces to tasks by key; each task packs its share best-fit,
   longest first.  Bins with at most ``slack`` free places are emitted.
3. The underfull bins of several tasks merge as the items of the next round
   (``fan_in`` tasks' bins into one), again best-fit, until one task's worth is
   left or a round no longer lowers their number; then all are emitted.

A task gets about ``rows_per_task`` pieces in each round, so memory is bounded
whatever the input.  Rows carry their place inside the bin they belong to, so
each round is one shuffle of (piece, bin, place) rows.  Each round is staged, so
a lost executor never changes a bin that is already emitted.

Ids are those of the ``tokenizers`` file.  Texts without characters from U+2000 on
and without special-token strings are encoded by ``tiktoken`` over the same
vocabulary (same ids, four times faster); all others by ``tokenizers`` itself.

Cases: null or empty text is the separator alone; repeated rows are packed as
rows of their own; a null id stays null; other columns are ignored; an empty
table packs into nothing.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
ROW = PIECE + ", key long, unit long, place long"


def byte_ranks(vocabulary: str) -> tuple[dict[bytes, int], list[str]]:
    """(bytes -> id, special strings) of a byte-level BPE file.

    Such files spell a byte that is printable in Latin-1 as itself and the n-th
    other byte as chr(256 + n).
    """
    spec = json.load(open(vocabulary, encoding="utf-8"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain}
    spelled |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(spelled[c] for c in token): i
             for token, i in spec["model"]["vocab"].items() if token not in special}
    return ranks, special


#: Fixed value: the pattern by which that file splits text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of byte strings, equal to those of ``tokenizers``."""

    def __init__(self, vocabulary: str):
        import tiktoken
        self.vocabulary, self.slow = vocabulary, None
        ranks, special = byte_ranks(vocabulary)
        self.special = [s.encode() for s in special]
        self.fast = tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, body: bytes) -> list[int]:
        if any(s in body for s in self.special) or (body and max(body) >= 0xE2):
            if self.slow is None:
                from tokenizers import Tokenizer
                self.slow = Tokenizer.from_file(self.vocabulary)
            return self.slow.encode(body.decode(), add_special_tokens=False).ids
        return self.fast.encode_ordinary(body.decode())


def _cut(vocabulary: str, capacity: int, separator: int):
    """Texts -> pieces with the checksum of their ids."""
    def run(batches):
        import pyarrow as pa
        encode = Encoder(vocabulary)
        for batch in batches:
            off, body = K.buffers(batch.column(1))
            body, ids, out = body.tobytes(), batch.column(0).to_pylist(), []
            for r, doc in enumerate(ids):
                tokens = np.array([*encode(body[off[r]:off[r + 1]]), separator], "<u4")
                n, a, piece = len(tokens), 0, 0
                while a < n:
                    b = a + (n - a) % capacity if piece == 0 and n > capacity and n % capacity else min(n, a + capacity)
                    out.append((doc, piece, a, b - a, zlib.crc32(tokens[a:b].tobytes())))
                    a, piece = b, piece + 1
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset) of each size in turn, and the fill of each bin.

    Bins stand in lists by free space; one big integer has a bit for each
    free space that occurs, so the tightest fit is its lowest bit from ``size`` on.
    """
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits, fill, where, offset = 0, [], [], []
    for size in sizes:
        above = bits >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                bits &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        where.append(b)
        offset.append(fill[b])
        fill[b] += size
        room -= size
        if room:
            free[room].append(b)
            bits |= 1 << room
    return where, offset, fill


def _pack(capacity: int, slack: int, last: bool):
    """Rows of whole units -> the same rows with their new unit, place and ``open``."""
    def run(batches):
        import pyarrow as pa
        t = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if t is None:
            return
        unit, place, length = (t.column(c).to_numpy() for c in ("unit", "place", "length"))
        ids, at = np.unique(unit, return_inverse=True)
        size = np.zeros(len(ids), np.int64)
        np.add.at(size, at, length)
        order = np.lexsort((ids, -size))
        where, offset, fill = (np.array(x, np.int64) for x in best_fit(size[order].tolist(), capacity))
        home, shift = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        home[order], shift[order] = where, offset
        name = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(name, home, ids)              # a bin is named by its least unit
        open_ = (capacity - fill > slack) & (not last)
        t = t.set_column(t.schema.get_field_index("unit"), "unit", pa.array(name[home[at]]))
        t = t.set_column(t.schema.get_field_index("place"), "place", pa.array(place + shift[at]))
        yield from t.append_column("open", pa.array(open_[home[at]])).to_batches(1 << 16)
    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, separator: int = 0, slack: int = 4,
         fan_in: int = 8, rows_per_task: int = 1 << 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = store.staged(texts.mapInArrow(_cut(vocabulary, capacity, separator), PIECE)
                          .withColumn("key", F.monotonically_increasing_id()), "pieces")
    rows = pieces.withColumn("unit", F.col("key")).withColumn("place", F.lit(0).cast("long"))
    n = rows.count()
    tasks = max(1, -(-n // rows_per_task))
    emitted, before = [], None
    while True:
        last = tasks == 1 or (before is not None and before[0] > 0.95 * before[1])
        packed = store.staged(rows.repartition(tasks, "unit").mapInArrow(
            _pack(capacity, slack, last), ROW + ", open boolean"), "round")
        if not emitted:
            store.drop_staged(pieces)
        emitted.append(packed.where("not open"))
        if last:
            break
        rows = packed.where("open").drop("open")
        left, bins = rows.agg(F.count(F.lit(1)), F.count_distinct("unit")).first()
        before = (bins, before[0] if before else n + 1)
        tasks = max(-(-tasks // fan_in), -(-left // rows_per_task), 1)
    out = emitted[0]
    for e in emitted[1:]:
        out = out.unionByName(e)
    return out.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32",
                      F.col("unit").alias("sequence_id"), F.col("place").alias("offset"))
