"""Benchmark decontamination by latent semantic retrieval.

1. Words are lower-cased and lose their ASCII punctuation.  Passages are runs of
   ``passage`` words; their document frequencies are summed over all texts.
2. Randomised SVD of the TF-IDF passages, distributed: tasks add X'(X W) over all
   passages, the driver takes the leading directions of the finished sum.
3. Every benchmark item and every window of every text (step ``step`` words, the
   window length nearest to the item's) becomes a whitened latent vector; pairs
   with cosine of ``least_cosine`` or more are candidates.  Window vectors are
   differences of prefix sums, so overlapping windows cost nothing extra.
4. A candidate is checked on its words: the longest common subsequence (LCS) of item and
   window must hold ``copied`` of the item's words, or, for a paraphrase,
   ``paraphrased`` of them while the item's answer (its last sentence, or the
   last quarter of a single sentence) is found to ``copied``.  Of neighbouring
   candidates of one item they are checked by falling number of words the item has,
   until one passes or none with enough of them is left.
5. Items with fewer than ``min_words`` words are also looked for at every place, by
   the hash of their words in a row, whatever their cosine.

The benchmark is the stated query set: it is broadcast in blocks of at most
``block_items`` items, one scan of the texts per block.

Cases: null or empty texts and items match nothing; items with fewer than
``min_words`` words must be found whole (cosine 1 where step 5 finds them); repeated rows report alike, once each;
a null doc_id stays null; items that repeat report under each of their ids.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, sums, textkernels as K
from bidscope.llm.quality import leading_directions, random_matrix

U64 = np.uint64
HITS = "doc_id long, item_id long, place long, cosine double, lcs long, item_words long, answer_found boolean"
_LENGTHS = (16, 24, 32, 48, 64, 96, 128, 192, 256)
_BITMAP = 12
_ANY = 20


def folded(off: np.ndarray, body: np.ndarray):
    """(hash, row) of the folded words of a slice."""
    h, row, _, _ = K.words(K.FOLD[body], off)
    return h, row


def _frequencies(passage: int, dims: int):
    def run(batches):
        df = np.zeros(dims + 1)
        for batch in batches:
            for a, b, off, body in K.slices(batch.column(0)):
                h, row = folded(off, body)
                first = K.first_places(row, b - a)
                unit = (np.arange(len(h)) - first[row]) // passage
                new = np.ones(len(h), bool)
                new[1:] = (unit[1:] != unit[:-1]) | (row[1:] != row[:-1])
                unit = np.cumsum(new) - 1
                pair = unit * dims + (h % U64(dims)).astype(np.int64)
                pair = np.sort(pair.astype(np.int32) if len(h) * dims < 1 << 31 else pair)
                once = np.ones(len(pair), bool)
                once[1:] = pair[1:] != pair[:-1]
                df[:dims] += np.bincount(pair[once] % dims, minlength=dims)
                df[dims] += unit[-1] + 1 if len(unit) else 0
        yield sums.part_rows(df)
    return run


def _products(passage: int, dims: int, idf, width: int, seed: int):
    def run(batches):
        w = random_matrix(dims, width, seed).astype(np.float32)
        total = np.zeros((width, dims))
        for batch in batches:
            for a, b, off, body in K.slices(batch.column(0), 1 << 20):
                h, row = folded(off, body)
                if not len(h):
                    continue
                unit = (np.arange(len(h)) - K.first_places(row, b - a)[row]) // passage
                new = np.ones(len(h), bool)
                new[1:] = (unit[1:] != unit[:-1]) | (row[1:] != row[:-1])
                pair = (np.cumsum(new) - 1) * dims + (h % U64(dims)).astype(np.int64)
                pair = np.sort(pair.astype(np.int32) if len(h) * dims < 1 << 31 else pair)
                # a passage's terms, once each, in passage order
                first = np.flatnonzero(np.diff(pair, prepend=-1))
                unit, term = np.divmod(pair[first].astype(np.int64), dims)
                x = np.diff(np.append(first, len(pair))).astype(np.float32) * idf[term]
                x /= np.sqrt(np.bincount(unit, x * x)).astype(np.float32)[unit]
                # passages as rows of up to ``passage`` terms, the rest zeros
                begin = np.flatnonzero(np.diff(unit, prepend=-1))
                place = np.arange(len(unit)) - begin[unit]
                terms, weight = np.zeros((len(begin), passage), np.int64), np.zeros((len(begin), 1, passage), np.float32)
                terms[unit, place], weight[unit, 0, place] = term, x
                y = np.matmul(weight, w[terms])[:, 0]
                for j, column in enumerate(np.ascontiguousarray(y.T)):
                    total[j] += np.bincount(term, column[unit] * x, dims)
        yield sums.part_rows(total.T)
    return run


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, one big integer per row of the table."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    free = full = (1 << len(a)) - 1
    for x in b:
        hit = places.get(x)
        if hit:
            use = free & hit
            free = (free + use | free - use) & full
    return len(a) - free.bit_count()


def answer_start(text: str, n_words: int, count) -> int:
    """Word place where an item's answer begins."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if count(p)]
    if len(parts) > 1:
        return n_words - count(parts[-1])
    return n_words - max(1, n_words // 4)


class Items:
    """One block of benchmark items, ready for search."""

    def __init__(self, ids, texts, terms, step: int):
        import pyarrow as pa
        self.ids, self.words, self.answer = [], [], []
        keep = []
        for i, text in zip(ids, texts):
            h = self._words(pa, text or "")
            if len(h):
                self.ids.append(i)
                self.words.append(h)
                self.answer.append(answer_start(text, len(h), lambda p: len(self._words(pa, p))))
                keep.append(terms[(h % U64(len(terms))).astype(np.int64)].sum(0))
        self.size = np.array([len(h) for h in self.words], np.int64)
        z = np.array(keep, np.float32).reshape(len(keep), terms.shape[1])
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        self.vectors = z / np.where(norm > 0, norm, np.inf)
        blocks = np.array([-(-n // step) for n in _LENGTHS])
        self.blocks = blocks[np.abs(np.array(_LENGTHS)[None, :] - self.size[:, None]).argmin(1)] \
            if len(self.size) else np.zeros(0, np.int64)
        over = self.size > _LENGTHS[-1]             # longer items: windows of their own length
        self.blocks[over] = -(-self.size[over] // step)
        self.any = np.zeros(1 << _ANY, np.int32)          # words of any item
        self.bitmap = np.zeros((len(self.words), 1 << _BITMAP), bool)
        for q, h in enumerate(self.words):
            self.bitmap[q, (h & U64((1 << _BITMAP) - 1)).astype(np.int64)] = True
            self.any[(h & U64((1 << _ANY) - 1)).astype(np.int64)] = 1

    def short(self, min_words: int):
        """(words, sorted hashes, their items) of items below ``min_words``, by number of words."""
        for n in np.unique(self.size[self.size < min_words]):
            q = np.flatnonzero(self.size == n)
            whole = np.array([K.window_hashes(self.words[i], int(n))[0] for i in q], U64)
            order = np.argsort(whole)
            yield int(n), whole[order], q[order]

    @staticmethod
    def _words(pa, text):
        (_, _, off, body), = K.slices(pa.array([text]))
        return folded(off, body)[0]


def _block_sums(terms: np.ndarray, term: np.ndarray, start: np.ndarray, step: int) -> np.ndarray:
    """Sum of the term vectors of each block of at most ``step`` words (one gather a place)."""
    size = np.diff(np.append(start, len(term)))
    out = terms[term[start]]
    for j in range(1, step):
        longer = np.flatnonzero(size > j)
        if len(longer) == len(start):
            out += terms[term[start + j]]
        else:
            out[longer] += terms[term[start[longer] + j]]
    return out


def _search(model, step: int, least_cosine: float, copied: float, paraphrased: float, min_words: int):
    def verdict(items, q, window):
        """(common, answer found) when the window holds the item, else None."""
        own = items.words[q].tolist()
        n = len(own)
        common = lcs(own, window)
        if n < min_words:
            return (common, True) if common == n else None
        if common < paraphrased * n:
            return None
        tail = own[items.answer[q]:]
        found = lcs(tail, window) >= copied * len(tail)
        return (common, found) if found or common >= copied * n else None

    def candidates(items, sums_, end, kind, often):
        """(window, item, cosine) above the bound for items of one window length.

        ``often`` tells how many words of each window, and a step around it, any item has:
        windows with too few for the smallest item cannot pass the check and are left out.
        """
        q = np.flatnonzero(items.blocks == kind)
        some = np.flatnonzero(often >= paraphrased * items.size[q].min())
        for a in range(0, len(some), 1 << 14):
            i = some[a:a + (1 << 14)]
            z = (sums_[np.minimum(i + kind, end[i])] - sums_[i]).astype(np.float32)
            norm = np.sqrt(np.einsum("ij,ij->i", z, z))
            sim = z @ items.vectors[q].T
            w, c = np.nonzero(sim >= least_cosine * np.maximum(norm, 1e-9)[:, None])
            if len(w):
                yield i[w], q[c], sim[w, c] / norm[w]

    def whole(short, h, row):
        """(row, item, place) where all words of a short item follow each other."""
        for n, known, q in short:
            at = K.window_hashes(h, n)
            lo, hi = np.searchsorted(known, at, "left"), np.searchsorted(known, at, "right")
            for p in np.flatnonzero((hi > lo) & K.inside(row, n)):
                for i in q[lo[p]:hi[p]]:
                    yield int(row[p]), int(i), int(p)

    def run(batches):
        import pyarrow as pa
        terms, items = model.value
        kinds = np.unique(items.blocks)
        short = list(items.short(min_words))
        for batch in batches:
            ids, out, exact = batch.column(1), [], []
            for a, b, off, body in K.slices(batch.column(0), 1 << 20):
                h, row = folded(off, body)
                if not len(h) or not len(kinds):
                    continue
                first = K.first_places(row, b - a)
                start = np.flatnonzero((np.arange(len(h)) - first[row]) % step == 0)
                per = _block_sums(terms, (h % U64(len(terms))).astype(np.int64), start, step)
                total = np.zeros((len(start) + 1, terms.shape[1]))
                np.cumsum(per, axis=0, out=total[1:])
                brow = row[start]
                end = K.first_places(brow, b - a)[brow + 1]
                small = (h & U64((1 << _BITMAP) - 1)).astype(np.int64)
                known = np.zeros(len(h) + 1, np.int32)
                np.cumsum(items.any[(h & U64((1 << _ANY) - 1)).astype(np.int64)], out=known[1:])
                before, last = np.maximum(start - step, first[brow]), first[brow + 1]
                for kind in kinds:
                    often = known[np.minimum(start + (kind + 1) * step, last)] - known[before]
                    for w, q, cos in candidates(items, total, end, int(kind), often):
                        # words of the window and one step around it that the item has too
                        lo = np.maximum(start[w] - step, first[brow[w]])
                        hi = np.minimum(start[w] + (kind + 1) * step, first[brow[w] + 1])
                        at = lo[:, None] + np.arange(int(kind + 2) * step)[None, :]
                        has = items.bitmap[q[:, None], small[np.minimum(at, len(h) - 1)]] & (at < hi[:, None])
                        near = has.sum(1)
                        ok = np.flatnonzero(near >= paraphrased * items.size[q])
                        order = ok[np.lexsort((w[ok], brow[w[ok]], q[ok]))]
                        # of overlapping windows of one item and text, the first that passes, most of its words first
                        i = 0
                        while i < len(order):
                            j = i + 1
                            while (j < len(order) and q[order[j]] == q[order[i]] and brow[w[order[j]]] == brow[w[order[i]]]
                                   and w[order[j]] - w[order[j - 1]] <= 1):
                                j += 1
                            run_ = order[i:j]
                            for x in run_[np.argsort(-near[run_], kind="stable")]:
                                got = verdict(items, int(q[x]), h[lo[x]:hi[x]].tolist())
                                if got:
                                    r = int(brow[w[x]])
                                    out.append((a + r, int(q[x]), int(start[w[x]] - first[r]), float(cos[x]), *got))
                                    break
                            i = j
                for r, q, p in whole(short, h, row):
                    exact.append((a + r, q, int(p - first[r]), 1.0, int(items.size[q]), True))
            best: dict = {}
            for r, q, place, cos, common, found in out:
                old = best.get((r, q))
                if old is None or (common, found, -place) > (old[2], old[3], -old[0]):
                    best[r, q] = (place, cos, common, found)
            best |= {(r, q): v for r, q, *v in reversed(exact)}         # the first place of each
            rows = [(ids[r].as_py(), items.ids[q], v[0], v[1], v[2], int(items.size[q]), v[3]) for (r, q), v in best.items()]
            cols = list(zip(*rows)) or [()] * 7
            kinds_ = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds_)],
                                             names=[f.split()[0] for f in HITS.split(", ")])
    return run


def latent_terms(texts: DataFrame, passage: int, dims: int, rank: int, width: int, seed: int):
    """(dims, rank) whitened, IDF-weighted latent vector of every term."""
    df = sums.summed(texts.select("text").mapInArrow(_frequencies(passage, dims), sums.PARTS), (dims + 1,))
    idf = (np.log((1 + df[dims]) / (1 + df[:dims]))).astype(np.float32) + np.float32(1e-3)
    product = sums.summed(texts.select("text").mapInArrow(
        _products(passage, dims, idf, width, seed), sums.PARTS), (dims, width))
    basis, spectrum = leading_directions(product, random_matrix(dims, width, seed), rank)
    use = spectrum > 1e-3 * max(spectrum.max(), 1e-300)      # below: noise of the products
    return (basis * np.where(use, 1 / np.where(use, spectrum, 1), 0) * idf[:, None]).astype(np.float32)


def contaminated(docs: DataFrame, benchmark: DataFrame, passage: int = 64, dims: int = 1 << 13, rank: int = 48,
                 width: int = 60, step: int = 8, least_cosine: float = 0.5,
                 copied: float = 0.8, paraphrased: float = 0.6, min_words: int = 8, block_items: int = 4096,
                 seed: int = 2, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """One row per (document, item) found: place (word of the document), cosine,
    lcs, item_words, answer_found."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                        F.col(id_col).cast("long").alias("doc_id"))
    terms = latent_terms(texts, passage, dims, rank, width, seed)
    queries = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t"))
    out, block = None, []

    def search(block):
        items = Items([r["i"] for r in block], [r["t"] for r in block], terms, step)
        model = spark.sparkContext.broadcast((terms, items))
        return texts.mapInArrow(_search(model, step, least_cosine, copied, paraphrased, min_words), HITS)

    for r in queries.where("t is not null").orderBy("i", "t").toLocalIterator():
        block.append(r)
        if len(block) == block_items:
            out, block = (search(block) if out is None else out.unionByName(search(block))), []
    if block:
        out = search(block) if out is None else out.unionByName(search(block))
    if out is None:
        out = spark.createDataFrame([], HITS)
    return out.withColumnsRenamed({"doc_id": id_col, "item_id": item_col})


def clean_documents(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents without a hit (null ids compare as equal)."""
    found = store.staged(hits.select(F.col(id_col).alias("_hit")).distinct(), "hits")
    return docs.join(found, docs[id_col].eqNullSafe(found["_hit"]), "left_anti")
