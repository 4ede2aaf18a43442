"""Quality by nearest-neighbour voting in a latent semantic space.

1. Terms of a word: its shape (kinds of its first, middle and last byte, length),
   whether it repeats the word before it, and its last three bytes, hashed into
   ``dims`` columns.  Document frequencies are summed over all documents.
2. Latent space: randomised SVD of the TF-IDF matrix of all documents.  Every
   task adds X'(X W) for a fixed random W; the driver gets the dims x width sum
   and takes the leading directions (Nystrom form, one pass over the texts).
3. At most ``max_labelled`` labelled rows, taken by hash of their id, become
   latent vectors.  They are the only broadcast, bounded by that parameter.
4. Every document: exact cosines to all of them in blocks, the ``k`` nearest vote
   (no more than the rarer label has vectors) with their similarity as weight, the
   labels balanced, smoothed towards the labels' mean.

Cases: null or empty text has no terms and scores the labels' mean; without any
usable label every score is 0.5; repeated rows score alike; labels of one id
that differ are averaged; null ids are scored but never learned from; a column
named ``score`` is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm import store, sums, textkernels as K

U64 = np.uint64
_ROWS = 1 << 10
_SHAPES = 5 * 5 * 5 * 4

_KIND = np.full(256, 4, np.int64)
_KIND[ord("a"):ord("z") + 1] = 0
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3


def term_counts(off: np.ndarray, body: np.ndarray, dims: int) -> np.ndarray:
    """(documents, dims) counts of the terms of a slice."""
    n = len(off) - 1
    starts, ends = K.spans(body, off)
    row = np.searchsorted(off, starts, "right") - 1
    bytes_ = K.byte_sums(body)
    word = K.span_hashes(bytes_, starts, ends)
    tail = K.span_hashes(bytes_, np.maximum(starts, ends - 3), ends)
    mid = (starts + ends) // 2
    shape = (((_KIND[body[starts]] * 5 + _KIND[body[mid]]) * 5 + _KIND[body[ends - 1]]) * 4
             + np.minimum((ends - starts) // 5, 3))
    again = np.zeros(len(word), np.int64)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    rest = _SHAPES + 2 + (tail % U64(dims - _SHAPES - 2)).astype(np.int64)
    at = np.concatenate([shape, _SHAPES + again, rest]) + np.tile(row, 3) * dims
    return np.bincount(at, minlength=n * dims).reshape(n, dims)


def _rows_of(batch, dims):
    """(first row, last row, counts) of blocks of documents."""
    for a, b, off, body in K.slices(batch.column(0), 2 << 20, _ROWS):
        yield a, b, term_counts(off, body, dims)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts, dtype=np.float32) * idf
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _frequencies(dims: int):
    def run(batches):
        df = np.zeros(dims + 1)
        for batch in batches:
            for a, b, counts in _rows_of(batch, dims):
                df[:dims] += (counts > 0).sum(0)
                df[dims] += b - a
        yield sums.part_rows(df)
    return run


def _products(dims: int, idf, width: int, seed: int):
    def run(batches):
        w = random_matrix(dims, width, seed).astype(np.float32)
        total = np.zeros((dims, width))
        for batch in batches:
            for _, _, counts in _rows_of(batch, dims):
                x = _weighted(counts, idf)
                total += x.T @ (x @ w)
        yield sums.part_rows(total)
    return run


def random_matrix(dims: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, width))


def leading_directions(product: np.ndarray, w: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvectors, roots of the eigenvalues) of A, the leading ones, from A W
    (A symmetric, not negative); zeros where A has fewer."""
    core = w.T @ product
    value, vector = np.linalg.eigh((core + core.T) / 2)
    use = value > 1e-7 * max(value.max(), 1e-300)       # directions that A reaches (products are float32)
    root = product @ (vector[:, use] / np.sqrt(value[use]))
    u, size, _ = np.linalg.svd(root, full_matrices=False)
    basis, spectrum = np.zeros((len(w), rank), np.float32), np.zeros(rank)
    basis[:, :min(rank, u.shape[1])] = u[:, :rank]
    spectrum[:min(rank, len(size))] = size[:rank]
    return basis, spectrum


def _latent(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    z = x @ basis
    size = np.linalg.norm(z, axis=1, keepdims=True)
    return z / np.where(size > 1e-6, size, np.inf)


def _embed(dims: int, model):
    def run(batches):
        import pyarrow as pa
        idf, basis = model.value
        for batch in batches:
            vec = [v.tobytes() for _, _, c in _rows_of(batch, dims) for v in _latent(_weighted(c, idf), basis)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(vec, pa.binary())],
                                             names=["id", "y", "vec"])
    return run


def vote(z: np.ndarray, vectors: np.ndarray, y: np.ndarray, k: int, prior: float, pull: float) -> np.ndarray:
    """Similarity-weighted vote of the k nearest labelled vectors, block by block.

    Both labels have the same total weight among all vectors.
    """
    out = np.full(len(z), prior)
    if not len(vectors):
        return out
    k = min(k, len(vectors))
    share = min(max(float(y.mean()), 1 / (len(y) + 1)), len(y) / (len(y) + 1))
    balance = y / (2 * share) + (1 - y) / (2 * (1 - share))
    for a in range(0, len(z), 256):
        sim = z[a:a + 256] @ vectors.T
        near = np.argpartition(sim, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(sim, near, 1), 0).astype(float) * balance[near]
        out[a:a + 256] = ((weight * y[near]).sum(1) + pull * prior) / (weight.sum(1) + pull)
    return out


def _score(dims: int, k: int, pull: float, model, skip: int):
    def run(batches):
        import pyarrow as pa
        idf, basis, vectors, y, prior = model.value
        for batch in batches:
            got = [vote(_latent(_weighted(c, idf), basis), vectors, y, k, prior, pull)
                   for _, _, c in _rows_of(batch, dims)]
            score = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[skip:], pa.array(score, pa.float64())],
                                             names=[*batch.schema.names[skip:], "score"])
    return run


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, max_labelled: int = 4096, k: int = 25,
                  dims: int = 2048, rank: int = 32, width: int = 40, pull: float = 1.0, seed: int = 9,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  keep_text: bool = False) -> DataFrame:
    """``docs`` plus ``score`` (share of label 1 among the neighbours), without its text
    unless ``keep_text``.

    ``learn`` says of ``labels`` which rows may be learned from.  At most
    ``max_labelled`` of them are used, chosen by a hash of their id.
    """
    sc = docs.sparkSession.sparkContext
    text = docs.select(_text(docs, text_col))
    df = sums.summed(text.mapInArrow(_frequencies(dims), sums.PARTS), (dims + 1,))
    idf = (np.log((1 + df[dims]) / (1 + df[:dims])) + 1).astype(np.float32)
    product = sums.summed(text.mapInArrow(_products(dims, idf, width, seed), sums.PARTS), (dims, width))
    basis, _ = leading_directions(product, random_matrix(dims, width, seed), rank)
    chosen = (labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.avg(label_col).cast("double").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    known = (docs.select(_text(docs, text_col), F.col(id_col).cast("long").alias("_id"))
             .join(F.broadcast(chosen), "_id")          # max_labelled rows
             .select("_text", "_id", "_y")
             .mapInArrow(_embed(dims, sc.broadcast((idf, basis))), "id long, y double, vec binary")
             .dropDuplicates(["id"]).orderBy("id").collect())
    vectors = np.array([np.frombuffer(r["vec"], np.float32) for r in known]).reshape(-1, basis.shape[1])
    y = np.array([r["y"] for r in known])
    prior = float(y.mean()) if len(y) else 0.5
    k = max(1, min(k, int(np.minimum((y > 0.5).sum(), (y <= 0.5).sum())) or k))
    row, rest = store.packed(docs, [text_col, "score"])
    frame = docs.select(F.col(text_col).cast("string").alias("text"), row)
    shape = T.StructType([f for f in frame.schema.fields if keep_text or f.name == "row"]).add("score", "double")
    out = frame.mapInArrow(_score(dims, k, pull, sc.broadcast((idf, basis, vectors, y, prior)),
                                  0 if keep_text else 1), shape)
    cols = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in docs.columns if c in rest or (keep_text and c == text_col)]
    return out.select(*cols, "score")
