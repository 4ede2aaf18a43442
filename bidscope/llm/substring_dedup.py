"""Substring dedup: count-min prefilter, then exact grouping of windows.

A window is ``k`` consecutive words of one text.  A word goes when a window
that covers it also starts earlier (smaller id, or same id and earlier place).

1. Each window has a representative: of its ``gram``-word hashes, the
   smallest.  Equal windows have equal representatives at different places,
   so a representative seen once belongs to unique windows only.  Neighbouring
   windows mostly share one, so there are about six times fewer of them.
2. Every task counts its representatives in a count-min sketch (sent sparse);
   the sketches are merged block by block and only "twice or more" is kept, one
   bit a cell.  A merged estimate is never below the true count of a window.
3. The second pass reads the texts again.  Windows estimated repeated are
   settled inside a slice of texts first (later copies go at once); the first of
   each slice is sent, grouped by its representative.  A window that is
   frequent everywhere is sent once per slice, so no group holds its copies.
4. Each group keeps the earliest start of every window and returns the rest as
   word ranges; texts join their own ranges and drop the covered words.
   Windows are equal when their 64-bit hashes and those of their representatives are.

A representative whose estimate reaches ``hot`` (a phrase in very many texts) does
not make a group: its windows are grouped one by one, by hash of window and
representative, so they spread over all tasks.

The merged sketch is the only broadcast: its bitmaps follow the text but never
pass ``max_sketch_mb``, and of its cells that reach ``hot``, and well above the mean
of all, there is a list.  Past that bound estimates get looser and step 3 sends more
windows, in the end all of them (8 bytes a word); the result stays the same and
the cost linear.

Cases: null or empty text has no words; a text with under ``k`` words loses
none; rows that repeat an id and its text are one document and share their
result, rows of one id (or without id) with different texts are different documents,
in the order of their texts' hashes; null ids order before all others; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K

U64 = np.uint64


def _representatives(h: np.ndarray, row: np.ndarray, k: int, gram: int):
    """(ok, place, value): per window start, its representative."""
    ok = K.inside(row, k)
    g = K.window_hashes(h, gram)
    at = K.window_argmin(g, k - gram + 1)
    return ok, at, g[at]


def _cells(rep: np.ndarray, depth_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of a representative, one for each row of the sketch."""
    mask = U64((1 << depth_bits) - 1)
    return rep & mask, rep >> U64(64 - depth_bits)


_BLOCK_BITS = 18
#: How far a cell must stand above the mean count to be called often; at most one in so many does.
_ABOVE_MEAN = 256


def _sketch_parts(k: int, gram: int, bits: int):
    """Task side of the sketch: (block, cells seen, cells seen twice, how often these)."""
    def run(batches):
        import pyarrow as pa
        seen = []
        for batch in batches:
            for _, _, off, body in K.slices(batch.column(0)):
                h, row, _, _ = K.words(body, off)
                ok, at, rep = _representatives(h, row, k, gram)
                fresh = np.flatnonzero(ok)
                if len(fresh):       # one count for each chosen place
                    at, rep = at[fresh], rep[fresh]
                    keep = np.ones(len(at), bool)
                    keep[1:] = at[1:] != at[:-1]
                    seen.append(rep[keep])
            if sum(map(len, seen)) > 4_000_000:
                yield from _emit(seen, bits, pa)
                seen = []
        if seen:
            yield from _emit(seen, bits, pa)

    def _emit(seen, bits, pa):
        rep = np.concatenate(seen)
        for depth, cells in enumerate(_cells(rep, bits)):
            cells, n = np.unique(cells, return_counts=True)
            block = (cells >> U64(_BLOCK_BITS)).astype(np.int64)
            edge = np.flatnonzero(np.diff(block, prepend=-1))
            low = (cells & U64((1 << _BLOCK_BITS) - 1)).astype(np.uint32)
            ids, once, twice, times = [], [], [], []
            for a, b in zip(edge, np.append(edge[1:], len(block))):
                ids.append(int(block[a]) << 1 | depth)
                once.append(low[a:b].tobytes())
                more = n[a:b] > 1
                twice.append(low[a:b][more].tobytes())
                times.append(n[a:b][more].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(x, pa.binary()) for x in (once, twice, times))],
                names=["block", "once", "twice", "times"])
    return run


def _merge_blocks(hot: int):
    """Sorted partial sketches -> one bitmap a block of cells seen twice, and its cells seen ``hot`` times."""
    def run(batches):
        import pyarrow as pa
        size, now, count = 1 << _BLOCK_BITS, None, None

        def out():
            blobs = np.packbits(count > 1).tobytes(), np.flatnonzero(count >= hot).astype(np.uint32).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs)],
                                              names=["block", "bitmap", "often"])

        for batch in batches:
            for block, once, twice, times in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block != now:
                    if now is not None:
                        yield out()
                    now, count = block, np.zeros(size, np.int64)
                count[np.frombuffer(once, np.uint32)] += 1          # distinct inside a part
                count[np.frombuffer(twice, np.uint32)] += np.frombuffer(times, np.uint32).astype(np.int64) - 1
        if now is not None:
            yield out()
    return run


def repeat_sketch(texts: DataFrame, k: int, gram: int, max_sketch_mb: int, hot: int, n_bytes: int):
    """(bits, bitmaps, often): merged count-min sketch, one bit a cell for "twice or
    more", and the sorted cells of each row that were seen ``hot`` times."""
    spark = texts.sparkSession
    want = max(1, n_bytes * 4 // 36)        # about four cells a representative
    most = int(max_sketch_mb * 8 * 2 ** 20 // 2).bit_length() - 1
    bits = max(_BLOCK_BITS, min(max(20, int(want).bit_length()), most))
    # a cell is often only well above the mean of all, so the list of such cells is a small share of the sketch
    hot = max(hot, _ABOVE_MEAN * (n_bytes // 36) >> bits)
    parts = texts.select("text").mapInArrow(
        _sketch_parts(k, gram, bits), "block long, once binary, twice binary, times binary")
    n = store.shuffle_partitions(spark)
    blocks = (parts.repartition(n, "block").sortWithinPartitions("block")
                   .mapInArrow(_merge_blocks(hot), "block long, bitmap binary, often binary"))
    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(2)]
    often: list = [[], []]
    step = 1 << (_BLOCK_BITS - 3)
    for r in blocks.collect():      # max_sketch_mb in all
        at = (r["block"] >> 1) * step
        maps[r["block"] & 1][at:at + step] = np.frombuffer(r["bitmap"], np.uint8)
        cells = np.frombuffer(r["often"], np.uint32).astype(U64)
        often[r["block"] & 1].append(cells + (U64(r["block"] >> 1) << U64(_BLOCK_BITS)))
    return bits, maps, [np.sort(np.concatenate([np.zeros(0, U64), *x])) for x in often]


def _at_least_twice(rep: np.ndarray, bits: int, maps) -> np.ndarray:
    hit = np.ones(len(rep), bool)
    for bitmap, cells in zip(maps, _cells(rep, bits)):
        byte = bitmap[(cells >> U64(3)).astype(np.int64)]
        hit &= (byte >> (U64(7) - (cells & U64(7))).astype(np.uint8)) & 1 == 1
    return hit


def _often(rep: np.ndarray, bits: int, often) -> np.ndarray:
    hit = np.ones(len(rep), bool)
    for known, cells in zip(often, _cells(rep, bits)):
        at = np.minimum(np.searchsorted(known, cells), max(len(known) - 1, 0))
        hit &= known[at] == cells if len(known) else False
    return hit


def _runs(flag_at: np.ndarray, *breaks: np.ndarray):
    """[a, b) index ranges of consecutive places that agree on ``breaks``."""
    if not len(flag_at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(flag_at, prepend=flag_at[0] - 2) != 1
    for x in breaks:
        new[1:] |= x[1:] != x[:-1]
    a = np.flatnonzero(new)
    return a, np.append(a[1:], len(flag_at))


def _send_windows(k: int, gram: int, sketch):
    """Windows estimated repeated: entries to group by ``rep`` (``wins``: their hashes, as
    long as they share a representative; hot ones alone) and ranges settled inside the slice."""
    def run(batches):
        import pyarrow as pa
        bits, maps, often = sketch.value
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            all_subs = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, off, body in K.slices(batch.column(2)):
                ids, subs = all_ids[a:b], all_subs[a:b]
                h, row, _, _ = K.words(body, off)
                ok, at, rep = _representatives(h, row, k, gram)
                if not len(ok):
                    continue
                place = np.flatnonzero(ok)
                place = place[_at_least_twice(rep[place], bits, maps)]
                if not len(place):
                    continue
                win = K.window_hashes(h, k)[place]
                r = row[place]
                start = place - K.first_places(row, b - a)[r]
                # earliest (id, start) of each window in this slice
                order = np.lexsort((start, subs[r], ids[r], rep[place], win))
                w, x, i, u, s = win[order], rep[place][order], ids[r][order], subs[r][order], start[order]
                new = np.ones(len(w), bool)
                new[1:] = (w[1:] != w[:-1]) | (x[1:] != x[:-1])
                head = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
                gone = np.zeros(len(w), bool)
                gone[order] = (i != i[head]) | (u != u[head]) | (s != s[head])
                key = rep[place]
                hot = _often(key, bits, often)
                key[hot] = K.mix(key[hot] + K.mix(win[hot]))
                yield _rows(pa, ids, subs, r, start, place, gone, key, win)

    def _rows(pa, ids, subs, r, start, place, gone, key, win):
        sel = np.flatnonzero(gone)
        a, b = _runs(place[sel], r[sel])
        at = sel[a]
        out = [ids[r[at]], subs[r[at]], start[at], b - a, K.mix(subs[r[at]].view(U64)).view(np.int64)]
        blobs = [None] * len(a)
        sel = np.flatnonzero(~gone)
        a, b = _runs(place[sel], r[sel], key[sel])
        at = sel[a]
        blobs += [win[sel[x:y]].tobytes() for x, y in zip(a, b)]
        ent = [ids[r[at]], subs[r[at]], start[at], b - a, key[at].view(np.int64)]
        cols = [np.concatenate([x, y]).astype(np.int64) for x, y in zip(out, ent)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in cols), pa.array(blobs, pa.binary())],
            names=["id", "sub", "start", "n", "rep", "wins"])
    return run


def _settle(batches):
    """Entries of whole groups -> ranges of windows that start earlier elsewhere; settled ranges as they are."""
    import pyarrow as pa
    import pyarrow.compute as pc
    names = ["id", "sub", "start", "n"]
    parts = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        sent = pc.is_valid(t.column("wins"))
        yield from t.filter(pc.invert(sent)).select(names).to_batches()
        parts.append(t.filter(sent))
    if not sum(map(len, parts)):
        return
    t = pa.concat_tables(parts).combine_chunks()
    ids, sub, start, n, rep = (t.column(c).to_numpy() for c in (*names, "rep"))
    w = np.frombuffer(b"".join(t.column("wins").to_pylist()), U64)
    ent = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    s = start[ent] + (np.arange(len(ent)) - first[ent])
    order = np.lexsort((s, sub[ent], ids[ent], w, rep[ent]))
    e, w, so = ent[order], w[order], s[order]
    new = np.ones(len(e), bool)
    new[1:] = (rep[e][1:] != rep[e][:-1]) | (w[1:] != w[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
    gone = np.zeros(len(e), bool)
    gone[order] = (ids[e] != ids[e][head]) | (sub[e] != sub[e][head]) | (so != so[head])
    sel = np.flatnonzero(gone)
    a, b = _runs(s[sel], ent[sel])
    at = ent[sel[a]]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids[at], sub[at], s[sel[a]], b - a)], names=names)


def repeated_ranges(texts: DataFrame, k: int = 20, gram: int = 10, max_sketch_mb: int = 128,
                    hot: int = 4096) -> DataFrame:
    """(id, sub, start, n): windows start .. start + n - 1 also start earlier elsewhere."""
    spark = texts.sparkSession
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sketch = spark.sparkContext.broadcast(repeat_sketch(texts, k, gram, max_sketch_mb, hot, n_bytes))
    sent = texts.select("id", "sub", "text").mapInArrow(
        _send_windows(k, gram, sketch), "id long, sub long, start long, n long, rep long, wins binary")
    n = max(store.shuffle_partitions(spark), n_bytes // (16 << 20))     # at most 8 bytes a word are sent
    return sent.repartition(n, "rep").mapInArrow(_settle, "id long, sub long, start long, n long")


def _keep_words(k: int, with_text: bool):
    """(id, text, starts, ns) -> words kept, joined by one space, and their digest."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            off, body = K.buffers(batch.column(1))
            body = body.tobytes()
            total, removed, digest, kept_text = [], [], [], []
            for r, (starts, ns) in enumerate(zip(batch.column(2), batch.column(3))):
                ws = body[off[r]:off[r + 1]].split()
                n = len(ws)
                if starts.is_valid and len(starts):
                    a = starts.values.to_numpy()
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, a, 1)
                    np.add.at(edge, np.minimum(a + ns.values.to_numpy() + k - 1, n), -1)
                    keep = np.cumsum(edge[:n]) == 0
                    ws = [w for w, ok in zip(ws, keep.tolist()) if ok]
                text = b" ".join(ws)
                total.append(n)
                removed.append(n - len(ws))
                digest.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept_text.append(text.decode())
            cols = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(digest, pa.string())]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols, names = cols + [pa.array(kept_text, pa.string())], names + ["kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def substring_dedup(docs: DataFrame, k: int = 20, gram: int = 10, max_sketch_mb: int = 128,
                    id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                    hot: int = 4096) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (and kept_text).

    ``gram`` is the length of the representatives (below ``k``), ``max_sketch_mb``
    bounds the merged sketch and ``hot`` the groups; none changes the result.
    """
    texts = store.keyed(docs, id_col, text_col)
    texts = texts.select("id", store.document_key()["sub"].alias("sub"), "text")
    ranges = (repeated_ranges(texts, k, gram, max_sketch_mb, hot)
              .distinct().groupBy("id", "sub").agg(F.collect_list(F.struct("start", "n")).alias("cut"))
              .select("id", "sub", F.col("cut.start").alias("starts"), F.col("cut.n").alias("ns")))
    kept = (texts.join(ranges, ["id", "sub"], "left").select("id", "text", "starts", "ns")
            .mapInArrow(_keep_words(k, with_text), "id long, n_words long, n_removed long, kept_sha256 string"
                        + ", kept_text string" * with_text))
    return kept.select(store.unkeyed().alias(id_col), *kept.columns[1:])
