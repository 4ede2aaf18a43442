"""Toxicity by non-negative positive-unlabelled learning.

1. Features of a text: its distinct words (lower case, ASCII punctuation off)
   and their first six and eight bytes, as 64-bit hashes.
2. Candidates: all features that at least ``min_df`` confirmed toxic texts share
   (at most ``max_positive`` texts).  Their document frequency in unlabelled text is
   then counted over all learnable documents, and those clearly more (or less)
   frequent among toxic texts stay, at most ``max_features``, the clearest first.
3. Linear classifiers in NumPy minimise the non-negative PU risk
       p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)])
   with logistic loss and class prior p.  The confirmed texts give E+; all learnable
   text (labels unused) gives Eu: it is dealt by hash to slices of about ``slice_rows``
   texts, at least ``members`` of them, and every slice fits a classifier.  When the
   second term falls below zero the step climbs out of it instead of overfitting.
   Texts of a slice with the same features are one row with a weight.
4. Every document is scored with the mean of the slices' classifiers, added up as a tree.

Broadcasts: candidates, bounded by the words of ``max_positive`` texts, weights, and the
confirmed texts' kept features, at most ``max_features`` of each.

Cases: null or empty text has no features and scores by the bias alone; without
confirmed texts every score is the prior; repeated rows score alike; null ids
are scored but not learned from as positives; a column named ``score`` is
replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, sums, textkernels as K

U64 = np.uint64
_PREFIXES = (6, 8)
_BITS = 20


def features(off: np.ndarray, body: np.ndarray):
    """(row, hash) of every word of a slice and of its prefixes (not distinct)."""
    body = K.FOLD[body]
    starts, ends = K.spans(body, off)
    row = np.searchsorted(off, starts, "right") - 1
    bytes_ = K.byte_sums(body)
    rows, hashes = [row], [K.span_hashes(bytes_, starts, ends)]
    for n in _PREFIXES:
        long = np.flatnonzero(ends - starts >= n)
        rows.append(row[long])
        hashes.append(K.span_hashes(bytes_, starts[long], starts[long] + n) ^ U64(n))
    return np.concatenate(rows), np.concatenate(hashes)


class Lookup:
    """Known hashes -> their places; a bitmap turns most others away first."""

    def __init__(self, known: np.ndarray):
        self.known = known                      # sorted
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(known & U64((1 << _BITS) - 1)).astype(np.int64)] = True

    def distinct(self, off, body):
        """(row, place) pairs of the known features of a slice, once per row."""
        row, h = features(off, body)
        near = np.flatnonzero(self.bitmap[(h & U64((1 << _BITS) - 1)).astype(np.int64)])
        row, h = row[near], h[near]
        at = np.searchsorted(self.known, h)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == h[hit]
        pair = np.unique(row[hit] * max(len(self.known), 1) + at[hit])
        return pair // max(len(self.known), 1), pair % max(len(self.known), 1)


def _positive_counts(batches):
    import pyarrow as pa
    for batch in batches:
        found = []
        for _, _, off, body in K.slices(batch.column(0)):
            row, h = features(off, body)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            found.append(h[new])
        h, n = np.unique(np.concatenate(found) if found else np.zeros(0, U64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])


def _unlabelled_counts(known):
    def run(batches):
        look = Lookup(known.value)
        df = np.zeros(len(look.known) + 1)
        for batch in batches:
            for a, b, off, body in K.slices(batch.column(0)):
                _, at = look.distinct(off, body)
                df[:-1] += np.bincount(at, minlength=len(look.known))
                df[-1] += b - a
        yield sums.part_rows(df)
    return run


def _feature_lists(known):
    def run(batches):
        import pyarrow as pa
        look = Lookup(known.value)
        for batch in batches:
            lists = []
            for a, b, off, body in K.slices(batch.column(0)):
                row, at = look.distinct(off, body)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                lists += [at[x:y].astype(np.int32).tobytes() for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(lists, pa.binary())],
                                             names=["id", "positive", "at"])
    return run


def clearest(z: np.ndarray, z_least: float, most: int) -> np.ndarray:
    """Places of the at most ``most`` largest |z| of ``z_least`` or more, in order."""
    size = np.abs(z)
    order = np.argsort(-size, kind="stable")[:most]
    return np.sort(order[size[order] >= z_least])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class _Rows:
    """0/1 features in row order and in column order, to be added up along either."""

    def __init__(self, row: np.ndarray, column: np.ndarray, n: int, n_features: int):
        self.n, self.n_features = n, n_features
        by_row, by_column = np.argsort(row, kind="stable"), np.argsort(column, kind="stable")
        self.column, self.row = column[by_row], row[by_column]
        self.rows, self.row_at = np.unique(row[by_row], return_index=True)
        self.columns, self.column_at = np.unique(column[by_column], return_index=True)

    def sums(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.rows):
            out[self.rows] = np.add.reduceat(w[self.column], self.row_at)
        return out

    def column_sums(self, slope: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n_features)
        if len(self.columns):
            out[self.columns] = np.add.reduceat(slope[self.row], self.column_at)
        return out


def fit_nnpu(pos, unl, n_features: int, prior: float, steps: int = 400, rate: float = 0.05,
             decay: float = 1e-4, gamma: float = 1.0, weight: np.ndarray | None = None):
    """(weights, bias) of the non-negative PU risk; ``pos`` and ``unl`` are
    (row, column, number of rows) of 0/1 features, ``weight`` tells how often each
    unlabelled row occurs.  Adam on full batches."""
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    share = np.full(unl[2], 1 / max(unl[2], 1)) if weight is None else weight / weight.sum()

    pos, unl = _Rows(*pos, n_features), _Rows(*unl, n_features)

    def scores(part):
        return part.sums(w) + b

    def back(part, slope):
        return np.append(part.column_sums(slope), slope.sum())

    for step in range(1, steps + 1):
        fp, fu = scores(pos), scores(unl)
        # logistic loss: l(f) = log(1 + exp(-f)), slopes of l(f) and of l(-f)
        up = back(pos, -_sigmoid(-fp) * prior / pos.n)
        neg = (np.logaddexp(0, fu) @ share - prior * np.logaddexp(0, fp).mean())
        down = back(unl, _sigmoid(fu) * share) - back(pos, _sigmoid(fp) * prior / pos.n)
        grad = up + down if neg >= 0 else -gamma * down
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def _fit_slice(shared, n_features: int, prior: float):
    """A slice's distinct feature lists -> its classifier (weights, bias, 1) in blocks."""
    def run(key, rows):
        import pandas as pd
        rows = rows.sort_values("at")
        w, b = fit_nnpu(shared.value, _as_csr([{"at": x} for x in rows["at"]], n_features), n_features, prior,
                        weight=rows["n"].to_numpy(dtype=float))
        out = sums.part_rows(np.concatenate([w, [b, 1.0]]))
        return pd.DataFrame({"block": out.column(0).to_pylist(), "part": int(key[0]), "data": out.column(1).to_pylist()})
    return run


def _score(model):
    def run(batches):
        import pyarrow as pa
        known, w, b = model.value
        look = Lookup(known)
        for batch in batches:
            out = np.full(batch.num_rows, b)
            for a, c, off, body in K.slices(batch.column(0)):
                row, at = look.distinct(off, body)
                out[a:c] += np.bincount(row, w[at], c - a)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(_sigmoid(out), pa.float64())],
                                             names=[*batch.schema.names[1:], "score"])
    return run


def _as_csr(rows, known_n):
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    cols = [np.frombuffer(r["at"], np.int32) for r in rows]
    return np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols).astype(np.int64), len(cols)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, max_positive: int = 4096,
                   slice_rows: int = 16384, max_features: int = 8192, min_df: int = 3, z_least: float = 4.0,
                   members: int = 1, class_prior: float | None = None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``docs`` without its text, plus ``score`` (probability of label 1).

    ``learn`` says (of an id column) which rows may be learned from.  At most
    ``max_positive`` confirmed texts are used, chosen by a hash of their id; all
    learnable texts are unlabelled ones.  ``class_prior`` defaults to the share of
    toxic rows among the learnable labels.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    usable = (labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).alias("_y")))
    if class_prior is None:
        class_prior = usable.agg(F.avg((F.col("_y") == 1).cast("double"))).first()[0] or 0.1
    prior = float(min(max(class_prior, 1e-3), 0.5))
    confirmed = (usable.where("_y = 1").orderBy(F.xxhash64("_id"), "_id").limit(max_positive).select("_id"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    base = docs.where(learn | F.col(id_col).isNull()).select(text, F.col(id_col).cast("long").alias("_id"))
    positive = base.join(F.broadcast(confirmed), "_id").select("_text", "_id")      # max_positive rows
    found = (positive.select("_text").mapInArrow(_positive_counts, "h long, n long")
             .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_df).toArrow())
    n_pos = positive.count()
    known = found.column("h").to_numpy().view(U64)
    in_pos = found.column("n").to_numpy().astype(float)
    order = np.argsort(known)
    known, in_pos = known[order], in_pos[order]
    df = sums.summed(base.select("_text").mapInArrow(_unlabelled_counts(sc.broadcast(known)), sums.PARTS),
                     (len(known) + 1,))
    n_all = df[-1]
    p, u = (in_pos + .5) / (n_pos + 1), (df[:-1] + .5) / (n_all + 1)
    z = (p - u) / np.sqrt(u * (1 - u) / max(n_pos, 1) + 1e-12)
    known = known[clearest(z, z_least, max_features)]
    held = sc.broadcast(known)
    positives = (positive.select("_text", "_id", F.lit(True).alias("_p"))
                 .mapInArrow(_feature_lists(held), "id long, positive boolean, at binary").orderBy("id", "at").collect())   # max_positive rows
    pos = _as_csr(positives, len(known))
    w, b = np.zeros(len(known)), float(np.log(prior / (1 - prior)))
    if pos[2] and n_all:
        slices = max(members, -(-int(n_all) // slice_rows))
        dealt = F.pmod(F.xxhash64(F.coalesce("_id", F.xxhash64("_text"))), F.lit(slices)).cast("int")
        lists = (base.select("_text", dealt.cast("long").alias("_id"), F.lit(False).alias("_p"))
                 .mapInArrow(_feature_lists(held), "id long, positive boolean, at binary")
                 .groupBy("id", "at").agg(F.count(F.lit(1)).alias("n")))
        # by range: neighbouring slices in one task, none left with several by chance
        fits = (lists.repartitionByRange(min(slices, store.shuffle_partitions(spark) * 8), "id").groupBy("id")
                .applyInPandas(_fit_slice(sc.broadcast(pos), len(known), prior), sums.DENSE))
        total = sums.tree_summed(fits, len(known) + 2, "float64", parts=slices)
        w, b = total[:-2] / total[-1], total[-2] / total[-1]
    row, rest = store.packed(docs, [text_col, "score"])
    frame = docs.select(text, row)
    out = frame.mapInArrow(_score(sc.broadcast((known, w, b))), frame.select("row").schema.add("score", "double"))
    return out.select(*[F.col("row")[c].alias(c) for c in rest], "score")
