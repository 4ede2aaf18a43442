"""Line dedup by winnowing over line hashes.

1. A line is a text's part between line feeds that has words; its hash is that of
   its words, so spaces do not matter.  Texts become sequences of line hashes.
2. A run is long enough with ``gram`` lines and ``min_words`` words.  The window of a
   line is the shortest long enough run from it on; of every window the line with the
   smallest hash is selected.  Every long enough run that repeats holds a whole window,
   so both copies select the same line of it: that is the guarantee.
3. Only selected lines are fingerprints and join their positions.  A position knows its
   context, a long enough run before and one after it.  Where all positions of a
   fingerprint have one context, every later position extends its match to both ends
   of the context, and those lines go.
4. Where contexts differ, a position is extended to each shortest run (from or up to a
   line) whose window selected it; each such run joins its own earliest place and
   goes from all others.  Fingerprints of one position, which are most, end in step 3.

So a line goes exactly when it lies in a run of ``gram`` lines and ``min_words``
words or more that also stands at an earlier place (smaller id, then earlier line), be
it one line or many: each line of such a run lies in a shortest run inside it, from
the line on or up to the run's end; the line selected for that run has it inside its
context.  Lines and runs count as equal when their 64-bit hashes are.  There is one
row per position or run, never a pair of a group.

A removed line always equals a line at an earlier place, so the first copy of
everything stays.

Cases: null and empty texts have no lines; blank lines stay and are not
compared; rows that repeat an id and its text are one document and share their
result, rows of one id (or without id) with different texts are different documents,
in the order of their texts' hashes; null ids order before all others; other columns
stay as they are, but for those named like a result, which are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K

U64 = np.uint64
KEY = "id struct<id:long,sub:long>"


def line_hashes(off: np.ndarray, body: np.ndarray):
    """(hash, row, words) of every line with words of a slice."""
    h, row, starts, _ = K.words(body, off)
    feed = np.flatnonzero(body == 10)
    unit = np.searchsorted(feed, starts)
    new = np.ones(len(h), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (row[1:] != row[:-1])
    first = np.append(np.flatnonzero(new), len(h))
    return K.row_hashes(h, first, 3), row[first[:-1]], np.diff(first)


def _reaches(n: np.ndarray, gram: int, min_words: int):
    """(end of the shortest long enough run from each line, start of that up to each
    line), by lines and words alone; they may leave the line's text."""
    total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    at = np.arange(len(n))
    end = np.maximum(np.searchsorted(total, total[:-1] + min_words), at + gram)
    start = np.minimum(np.searchsorted(total, total[1:] - min_words, "right") - 1, at + 1 - gram)
    return end, start


def range_argmin(v: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place of the rightmost minimum of each range [start, end), by doubling."""
    size = end - start
    out = np.zeros(len(start), np.int64)
    best, width = np.arange(len(v)), 1
    while len(size) and width <= size.max():
        use = np.flatnonzero((size >= width) & (size < 2 * width))
        a, b = best[start[use]], best[end[use] - width]
        out[use] = np.where(v[b] <= v[a], b, a)
        a, b = best[:-width], best[width:]
        best, width = np.where(v[b] <= v[a], b, a), 2 * width
    return out


def selected(h: np.ndarray, row: np.ndarray, n: np.ndarray, first: np.ndarray, gram: int, min_words: int):
    """(place, context start, context end) of the selected lines, in order, and
    (index of the selected line, start, end) of the shortest runs, each with the line
    that the window of its first line selects."""
    end, start = _reaches(n, gram, min_words)
    at = np.arange(len(h))
    lo, hi = first[row], first[row + 1]
    window = np.flatnonzero(end <= hi)
    choice = np.full(len(h), -1, np.int64)
    choice[window] = range_argmin(h, window, end[window])
    place = np.unique(choice[window])
    after, before = np.minimum(place + 1, len(h) - 1), np.maximum(place - 1, 0)
    right = np.where(place + 1 < hi[place], np.minimum(end[after], hi[place]), hi[place])
    left = np.where(place > lo[place], np.maximum(start[before], lo[place]), lo[place])
    up = np.flatnonzero(start >= lo)
    pair = np.unique(np.concatenate([window * (len(h) + 1) + end[window], start[up] * (len(h) + 1) + at[up] + 1]))
    a, b = pair // (len(h) + 1), pair % (len(h) + 1)
    return place, left, right, np.searchsorted(place, choice[a]), a, b


PLACE = f"fp long, context long, {KEY}, place long, start long, n long, runs binary"


def _positions(gram: int, min_words: int):
    """Texts -> the positions of their fingerprints, with context and shortest runs."""
    def run(batches):
        import pyarrow as pa
        kind = np.dtype([("key", "<i8"), ("start", "<i8"), ("n", "<i8")])
        for batch in batches:
            for s, e, off, body in K.slices(batch.column(1)):
                h, row, n = line_hashes(off, body)
                if not len(h):
                    continue
                first = K.first_places(row, e - s)
                place, left, right, owner, a, b = selected(h, row, n, first, gram, min_words)
                if not len(place):
                    continue
                base = first[row[place]]
                context = K.mix(K.run_hashes(h, left, right, 7) + (place - left).astype(U64))
                order = np.argsort(owner, kind="stable")
                runs = np.empty(len(a), kind)
                runs["key"] = K.run_hashes(h, a, b, 5)[order].view(np.int64)
                runs["start"], runs["n"] = (a - first[row[a]])[order], (b - a)[order]
                cut = np.searchsorted(owner[order], np.arange(len(place) + 1))
                blobs = [runs[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[place].view(np.int64)), pa.array(context.view(np.int64)),
                     batch.column(0).take(pa.array(s + row[place])), pa.array(place - base), pa.array(left - base),
                     pa.array(right - left), pa.array(blobs, pa.binary())],
                    names=["fp", "context", "id", "place", "start", "n", "runs"])
    return run


def _runs(batches):
    """Positions -> their shortest runs."""
    import pyarrow as pa
    kind = np.dtype([("key", "<i8"), ("start", "<i8"), ("n", "<i8")])
    for batch in batches:
        blobs = batch.column(1).to_pylist()
        runs = np.frombuffer(b"".join(blobs), kind)
        at = np.repeat(np.arange(len(blobs)), [len(x) // kind.itemsize for x in blobs])
        yield pa.RecordBatch.from_arrays([*(pa.array(runs[c]) for c in ("key", "start", "n")), batch.column(0).take(pa.array(at))],
                                         names=["fp", "place", "n", "id"])


def _later(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of groups with several places; the join key is a new column, so that a
    frequent one can be split."""
    return rows.withColumn("key", F.bitwise_not("fp")).join(
        groups.where("one <> other").withColumn("key", F.bitwise_not("fp")).drop("fp", "other"), "key").drop("key")


def repeated_runs(texts: DataFrame, gram: int, min_words: int) -> DataFrame:
    """(id, start, n): runs of lines that stand at an earlier place, too.

    ``texts`` is (id, text), the id a struct of the given id and the text's hash.
    """
    ends = [F.min(F.struct("id", "place")).alias("one"), F.max(F.struct("id", "place")).alias("other")]
    later = (F.col("id") != F.col("one.id")) | (F.col("place") != F.col("one.place"))
    rows = store.staged(texts.mapInArrow(_positions(gram, min_words), PLACE), "positions")
    groups = rows.groupBy("fp").agg(*ends, F.min("context").alias("c0"), F.max("context").alias("c1"))
    found = store.staged(_later(rows, groups).where((F.col("c0") != F.col("c1")) | later)
                         .select("id", "start", "n", F.when(F.col("c0") != F.col("c1"), F.col("runs")).alias("runs")), "matches")
    runs = store.staged(found.where("runs is not null").select("id", "runs")
                        .mapInArrow(_runs, f"fp long, place long, n long, {KEY}"), "runs")
    extended = _later(runs, runs.groupBy("fp").agg(*ends)).where(later).select("id", F.col("place").alias("start"), "n")
    store.drop_staged(rows)
    return found.where("runs is null").select("id", "start", "n").unionByName(extended)


def _cut_lines(batches):
    """(row, text, starts, ns) -> (row, text without these lines, n_lines, n_removed)."""
    import pyarrow as pa
    for batch in batches:
        texts, total, removed = [], [], []
        for text, starts, ns in zip(*(batch.column(i) for i in (1, 2, 3))):
            text = text.as_py()
            if text is None or not starts.is_valid:
                texts.append(text)
                total.append(sum(1 for x in (text or "").encode().split(b"\n") if x.strip()))
                removed.append(0)
                continue
            gone = {p for a, n in zip(starts.as_py(), ns.as_py()) for p in range(a, a + n)}
            kept, line = [], 0
            for part in text.encode().split(b"\n"):
                if part.strip():
                    line += 1
                    if line - 1 in gone:
                        continue
                kept.append(part)
            texts.append(b"\n".join(kept).decode())
            total.append(line)
            removed.append(len(gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
                                          pa.array(removed, pa.int64())], names=["row", "text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, gram: int = 1, min_words: int = 10, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines cut from its text, plus n_lines and n_removed.

    Finds every repeated run of ``gram`` lines and ``min_words`` words.
    """
    runs = (repeated_runs(store.keyed(docs, id_col, text_col).select(store.document_key().alias("id"), "text"),
                          gram, min_words).distinct()
            .groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("cut"))
            .select(F.col("id").alias("key"), "cut"))
    new = ["n_lines", "n_removed"]
    row, rest = store.packed(docs, [text_col, *new])
    rows = docs.select(store.document_key(id_col, text_col).alias("key"), row,
                       F.col(text_col).cast("string").alias("text"))
    cut = (rows.join(runs, "key", "left").select("row", "text", F.col("cut.start").alias("s"), F.col("cut.n").alias("n")))
    shape = cut.select("row", "text").schema.add("n_lines", "long").add("n_removed", "long")
    out = cut.mapInArrow(_cut_lines, shape)
    cols = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in new]
    return out.select(*cols, *new)
