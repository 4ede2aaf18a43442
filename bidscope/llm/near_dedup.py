"""Near-duplicates of word-shingle multisets by BagMinHash.

1. Texts with the same words are one representative (128-bit digest of the word
   sequence); the rest of the work is done once per representative.
2. A text's bag holds its ``shingle``-word runs with their counts.  Weights are
   discretised to whole counts and cut into dyadic strips (0,1], (1,2], (2,4], ...
   Each (shingle, strip) drives its own Poisson process of rate equal to the
   strip's width; a point has a time, a register and a level in its strip, and
   counts for a bag only if the level is within the bag's weight.  A register
   keeps its earliest point, so two bags agree in a register with probability
   equal to their weighted Jaccard similarity.  Points are drawn in time order
   and only until all registers of a text are filled.
3. ``bands`` keys of ``rows`` registers each bucket the representatives.
4. Each bucket compares all members with its hub, the member with most bucket
   mates (a star); verified links (exact weighted Jaccard of the two bags >=
   ``threshold``) merge components.
5. What lies in different components of one bucket then is compared in blocks.  The
   members outside the bucket's largest component are dealt to blocks that meet each
   other and the largest component's blocks, which need not meet among themselves.  A
   pair is looked at in the first of its common buckets: a second, longer signature
   of ``registers`` places passes what agrees in nearly ``threshold`` of them (``sigma``
   standard errors below), the bags themselves decide.  Links merge components inside
   the block at once and only merging links leave it, so copies are never expanded,
   a group of near copies costs its members and not its pairs, and no group is in one
   task.
6. A class is a connected component, named by its least id.

With 32 bands of 6 a pair of similarity 0.8 shares a bucket with probability
0.99994; the test of step 5 passes it with 0.99997.

Cases: null and empty texts have no words and form one class; a text with fewer
words than a shingle has one shingle, all its words.  Rows that repeat an id and its
text are one document: they are in one class and alike, and both kept or not.  Rows of
one id, or without id, with different texts are different documents, ordered by their
texts' hashes, and share a class only if their texts are near.  Null ids order before
all others; other columns are ignored, whatever their names; an empty table gives an
empty result; texts are taken whole, whatever their length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K
from bidscope.llm.components import components

U64 = np.uint64
_GOLD = U64(0x9E3779B97F4A7C15)


def bags(off: np.ndarray, body: np.ndarray, k: int):
    """(row, shingle, count) of a slice, ordered by row, and the words' hashes and rows."""
    n = len(off) - 1
    h, row, _, _ = K.words(body, off)
    ok = K.inside(row, k)
    sh, r = K.window_hashes(h, k)[ok], row[:len(ok)][ok]
    first = K.first_places(row, n)
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        whole = np.zeros(len(short), U64)
        for j in range(k - 1):
            use = size[short] > j
            whole[use] = K.mix(whole[use] + h[first[short[use]] + j] + U64(j + 1))
        sh, r = np.concatenate([sh, whole]), np.concatenate([r, short])
    order = np.lexsort((sh, r))
    sh, r = sh[order], r[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return r[at], sh[at], np.diff(np.append(at, len(sh))), h, row


def signatures(row: np.ndarray, sh: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) BagMinHash registers: the hash that made each register's earliest point."""
    strips = np.zeros(len(count), np.int64)
    more = count > 1
    strips[more] = np.ceil(np.log2(count[more])).astype(np.int64)
    el = np.repeat(np.arange(len(count)), strips + 1)
    j = np.arange(len(el)) - np.repeat(np.cumsum(strips + 1) - strips - 1, strips + 1)
    low = np.where(j > 0, 1 << np.maximum(j - 1, 0), 0)
    width = np.maximum(low, 1)
    seed = K.mix(sh[el] + (j + 1).astype(U64) * _GOLD)
    r, w = row[el], count[el]
    total = np.zeros(n)
    np.add.at(total, row, count)
    full = total > 0
    limit = np.where(full, m / np.maximum(total, 1) * (np.log(m) + 2), 0)
    best, who = np.full(n * m, np.inf), np.zeros(n * m, U64)
    tick = np.zeros(len(el), U64)

    def wait(at):
        u = K.mix(seed[at] ^ (tick[at] * U64(0xD6E8FEB86659FD93)))
        return -np.log(((u >> U64(11)).astype(float) + 0.5) / 2 ** 53) / width[at], u

    t, point = wait(np.arange(len(el)))
    todo = np.arange(len(el))
    while len(todo):
        now = todo[t[todo] <= limit[r[todo]]]
        while len(now):
            u = K.mix(point[now] + _GOLD)
            place = r[now] * m + ((u >> U64(32)) % U64(m)).astype(np.int64)
            level = low[now] + 1 + ((u & U64(0xFFFFFFFF)) % width[now].astype(U64)).astype(np.int64)
            use = level <= w[now]
            place, time, mark = place[use], t[now][use], u[use]
            np.minimum.at(best, place, time)
            won = best[place] == time
            who[place[won]] = mark[won]
            tick[now] += U64(1)
            gap, point[now] = wait(now)
            t[now] += gap
            now = now[t[now] <= limit[r[now]]]
        open_rows = full & ~np.isfinite(best.reshape(n, m)).all(1)
        limit = np.where(open_rows, limit * 1.5, limit)
        todo = np.flatnonzero(open_rows[r])
    return who.reshape(n, m)


def _describe(k: int, bands: int, rows: int):
    """Texts -> digest of their words, size of their bag, band keys."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            d1, d2, size, keys = [], [], [], []
            for a, b, off, body in K.slices(batch.column(1), max_rows=2048):
                n = b - a
                r, sh, count, h, row = bags(off, body, k)
                first = K.first_places(row, n)
                d1.append(K.row_hashes(h, first, 1))
                d2.append(K.row_hashes(h, first, 2))
                total = np.zeros(n, np.int64)
                np.add.at(total, r, count)
                size.append(total)
                sig = signatures(r, sh, count, n, bands * rows).reshape(n, bands, rows)
                key = np.zeros((n, bands), U64)
                for i in range(rows):
                    key = K.mix(key + sig[:, :, i])
                keys += [x.tobytes() for x in key]
            cols = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((d1, U64), (d2, U64), (size, np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c.view(np.int64)) for c in cols), pa.array(keys, pa.binary())],
                names=["key", "d1", "d2", "size", "bands"])
    return run


def _marks(k: int, registers: int):
    """Texts -> a second signature, independent of the bands, one byte a register, and the bag."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            marks, shingles, counts = [], [], []
            for a, b, off, body in K.slices(batch.column(1), max_rows=1024):
                r, sh, count, _, _ = bags(off, body, k)
                sig = signatures(r, K.mix(sh ^ _GOLD), count, b - a, registers)
                marks += [x.tobytes() for x in (sig & U64(255)).astype(np.uint8)]
                first = K.first_places(r, b - a)
                shingles += [sh[x:y].tobytes() for x, y in zip(first[:-1], first[1:])]
                counts += [count[x:y].astype(np.int32).tobytes() for x, y in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in (marks, shingles, counts))],
                                             names=["rep", "marks", "shingles", "counts"])
    return run


def _explode_bands(batches):
    import pyarrow as pa
    for batch in batches:
        blob = batch.column(2).to_pylist()
        if not blob:
            continue
        keys = np.frombuffer(b"".join(blob), U64).reshape(len(blob), -1)
        n, b = keys.shape
        band = np.tile(np.arange(b), n)
        bucket = K.mix(keys.ravel() + band.astype(U64) * _GOLD).view(np.int64)
        take = np.repeat(np.arange(n), b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(band.astype(np.int32)),
             batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take))],
            names=["bucket", "band", "rep", "size"])


def _similar(k: int, threshold: float):
    """(u, v, text of u, text of v) -> the pairs whose bags are similar enough."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for a, b, off, body in K.slices(batch.column(2), 2 << 20):
                off2, body2 = K.buffers(batch.column(3).slice(a, b - a))
                r1, s1, c1, _, _ = bags(off, body, k)
                r2, s2, c2, _, _ = bags(off2, body2, k)
                r, s, c = np.concatenate([r1, r2]), np.concatenate([s1, s2]), np.concatenate([c1, c2])
                order = np.lexsort((s, r))
                r, s, c = r[order], s[order], c[order]
                total, both = np.zeros(b - a), np.zeros(b - a)
                np.add.at(total, r, c)
                same = np.flatnonzero((s[1:] == s[:-1]) & (r[1:] == r[:-1]))
                np.add.at(both, r[same], np.minimum(c[same], c[same + 1]))
                jac = both / np.maximum(total - both, 1)
                hit = pa.array(np.flatnonzero(jac >= threshold) + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(hit), batch.column(1).take(hit)],
                                                 names=["u", "v"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    a = texts.select(F.col("key").alias("u"), F.col("text").alias("ta"))
    b = texts.select(F.col("key").alias("v"), F.col("text").alias("tb"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "ta", "tb")
            .mapInArrow(_similar(k, threshold), f"u {KEY}, v {KEY}"))


def _in_reach(a: str, b: str, threshold: float):
    """Similarity is at most the ratio of the bag sizes."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(threshold)


def _close(m: int, threshold: float, sigma: float):
    """Rows of pairs of blocks, ordered by (bucket, lo, hi) -> links that merge components.

    A pair of several common buckets is left to the first of their bands.
    """
    least = m * (threshold - sigma * (threshold * (1 - threshold) / m) ** 0.5)

    def similar(one, others, bags_, size):
        """Which of the others' bags are similar enough to the one's."""
        sh, ct = bags_[one]
        lengths = [len(bags_[o][0]) for o in others]
        all_sh, all_ct = (np.concatenate([bags_[o][i] for o in others]) for i in (0, 1))
        at = np.minimum(np.searchsorted(sh, all_sh), len(sh) - 1)
        both = np.where(sh[at] == all_sh, np.minimum(ct[at], all_ct), 0)
        common = np.bincount(np.repeat(np.arange(len(others)), lengths), both, len(others))
        return common >= threshold * (size[one] + size[others] - common)

    def links(group):
        band, blk, size, comp, keys, marks, bags_ = group
        lo, hi = blk.min(), blk.max()
        left, right = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
        u, v = [], []
        for i in left:
            other = right[right > i] if lo == hi else right
            other = other[comp[other] != comp[i]]
            other = other[np.minimum(size[i], size[other]) >= np.maximum(size[i], size[other]) * threshold]
            if len(other):
                other = other[(keys[other] == keys[i]).argmax(1) == band[i]]
            if len(other):
                agree = (marks[other] == marks[i]).sum(1)
                other, agree = other[agree >= least], agree[agree >= least]
                other = other[np.argsort(-agree, kind="stable")]
            tries = 1
            while len(other):
                # the likeliest of each component first; more of them as long as none is linked
                rank = np.zeros(len(other), np.int64)
                order = np.argsort(comp[other], kind="stable")
                c = comp[other][order]
                start = np.flatnonzero(np.diff(c, prepend=c[0] - 1))
                rank[order] = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
                now, other = other[rank < tries], other[rank >= tries]
                for j in now[similar(i, now, bags_, size)]:
                    if comp[j] != comp[i]:
                        u.append(i)
                        v.append(j)
                        comp[comp == comp[j]] = comp[i]
                other = other[comp[other] != comp[i]]
                tries *= 4
        return np.array(u, np.int64), np.array(v, np.int64)

    def run(batches):
        import pyarrow as pa

        def arrays(t):
            plain = [t.column(c).to_numpy() for c in ("band", "blk", "size")]
            comp = t.column("comp").combine_chunks()
            comp = np.unique(np.stack([comp.field(f).to_numpy() for f in ("id", "sub")], 1), axis=0, return_inverse=True)[1].ravel()
            keys, marks = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(len(t), -1)
                           for c, kind in (("bands", np.uint64), ("marks", np.uint8)))
            bags_ = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.int32))
                     for x, y in zip(t.column("shingles").to_pylist(), t.column("counts").to_pylist())]
            return [*plain, comp, keys, marks, bags_]

        def found(parts):
            t = pa.concat_tables(parts).combine_chunks()
            u, v = links(arrays(t))
            if len(u):
                rep = t.column("rep").combine_chunks()
                return pa.RecordBatch.from_arrays([rep.take(pa.array(u)), rep.take(pa.array(v))], names=["u", "v"])

        left, key = [], None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            ids = np.stack([t.column(c).to_numpy() for c in ("bucket", "lo", "hi")], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1), len(ids)] if len(ids) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if key is not None and tuple(ids[a]) != key:
                    if (out := found(left)) is not None:
                        yield out
                    left = []
                key = tuple(ids[a])
                left.append(t.slice(a, b - a))
        if left and (out := found(left)) is not None:
            yield out
    return run


BLOCK = 256


def block_rows(state: DataFrame) -> DataFrame:
    """Rows of the undecided buckets with the blocks (lo, hi) in which they meet, ``blk`` their own.

    Members outside the largest component stand in blocks from 0 on, the others in the
    blocks after them; only pairs with one of the former are made.
    """
    per = state.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    sizes = (per.groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("comps"))
             .where("comps > 1")
             .select(F.bitwise_not("bucket").alias("key"), F.col("top.comp").alias("major"),
                     F.ceil((F.col("n") - F.col("top.c")) / BLOCK).cast("int").alias("no"),
                     F.ceil(F.col("top.c") / BLOCK).cast("int").alias("nm")))
    rows = (state.withColumn("key", F.bitwise_not("bucket")).join(sizes, "key").drop("key")
            .withColumn("big", F.col("comp") == F.col("major")))
    place = F.xxhash64("rep")
    rows = rows.withColumn("blk", F.when(F.col("big"), F.col("no") + F.pmod(place, F.col("nm")))
                           .otherwise(F.pmod(place, F.col("no"))).cast("int"))
    last = F.when(F.col("big"), F.col("no")).otherwise(F.col("no") + F.col("nm")) - 1
    return (rows.withColumn("o", F.explode(F.sequence(F.lit(0), last)))
            .select("bucket", F.least("blk", "o").alias("lo"), F.greatest("blk", "o").alias("hi"), "band", "blk", "rep", "size", "comp"))


def _close_links(state: DataFrame, reps: DataFrame, held: DataFrame, shingle: int, registers: int,
                 threshold: float, sigma: float) -> DataFrame:
    """Links (u, v) between different components of undecided buckets, by blocks of members."""
    asked = state.select(F.col("rep").alias("key")).distinct()
    marks = held.join(asked, "key", "left_semi").mapInArrow(_marks(shingle, registers), f"rep {KEY}, marks binary, shingles binary, counts binary")
    own = store.staged(marks.join(reps.select("rep", "bands"), "rep"), "marks")
    n = store.shuffle_partitions(state.sparkSession)
    return (block_rows(state).join(own, "rep").repartition(n, "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
            .select("bucket", "lo", "hi", "band", "blk", "rep", "size", "comp", "bands", "marks", "shingles", "counts")
            .mapInArrow(_close(registers, threshold, sigma), f"u {KEY}, v {KEY}"))


def _relabel(state: DataFrame, comps: DataFrame) -> DataFrame:
    """Bucket rows with their components merged by ``comps`` (node, comp)."""
    return (state.join(comps.select(F.col("node").alias("rep"), F.col("comp").alias("to")), "rep", "left")
            .select("bucket", "band", "rep", "size", F.coalesce("to", "rep").alias("comp")))


def _mated(spread: DataFrame) -> DataFrame:
    """Rows of buckets with company, with each member's number of bucket mates.

    Join keys are new columns, so a bucket of very many rows can be split.
    """
    sizes = (spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.bitwise_not("bucket").alias("key"), "n"))
    rows = store.staged(spread.withColumn("key", F.bitwise_not("bucket")).join(sizes, "key").drop("key"), "buckets")
    degree = rows.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("degree"))
    return rows.drop("n").join(degree, "rep").select("bucket", "band", "rep", "size", "degree")


def _with_hubs(rows: DataFrame) -> DataFrame:
    """Bucket rows with their bucket's hub."""
    hub = F.min(F.struct((-F.col("degree")).alias("d"), "rep", "size"))
    hubs = rows.groupBy("bucket").agg(hub.alias("hub")).select(F.bitwise_not("bucket").alias("key"), "hub")
    return (rows.withColumn("key", F.bitwise_not("bucket")).join(hubs, "key")
            .select("bucket", "band", "rep", "size", F.col("hub.rep").alias("hub"), F.col("hub.size").alias("hub_size")))


KEY = "struct<id:long,sub:long>"


def near_classes(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 6,
                 registers: int = 512, sigma: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, class) of every row; both are ``store.document_key`` values, the class the least of its members."""
    texts = docs.select(store.document_key(id_col, text_col).alias("key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    read = store.staged(texts.mapInArrow(_describe(shingle, bands, rows),
                                         f"key {KEY}, d1 long, d2 long, size long, bands binary"), "bags")
    reps = read.groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.max("size").alias("size"), F.first("bands").alias("bands"))
    reps = store.staged(reps, "reps")
    spread = (reps.where("size > 0").select("rep", "size", "bands")
              .mapInArrow(_explode_bands, f"bucket long, band int, rep {KEY}, size long"))
    state = store.staged(_with_hubs(_mated(spread)), "undecided")
    wanted = state.select(F.col("rep").alias("key")).distinct().hint("merge")     # alike at every size
    held = store.staged(texts.join(wanted, "key", "left_semi").dropDuplicates(["key"]), "texts")
    stars = (state.where((F.col("hub") != F.col("rep")) & _in_reach("size", "hub_size", threshold))
             .select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct())
    links = store.staged(_links(stars, held, shingle, threshold), "found")
    comps = components(links)
    rest = store.staged(_relabel(state.where(F.col("rep") != F.col("hub")), comps), "undecided")
    more = store.staged(_close_links(rest, reps, held, shingle, registers, threshold, sigma), "found")
    if not more.isEmpty():
        comps = components(comps.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(more))
    member = read.select("key", "d1", "d2").join(reps.select("rep", F.col("d1").alias("e1"), F.col("d2").alias("e2")),
                                                 (F.bitwise_not("d1") == F.bitwise_not("e1")) & (F.col("d2") == F.col("e2")))
    named = store.staged(member.join(comps, member.rep == comps.node, "left").select("key", F.coalesce("comp", "rep").alias("class")), "classes")
    store.drop_staged(read, reps, state, rest, held, links, more, comps)
    return named


def near_dedup(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per row of ``docs``: id, class_id, class_size, kept (the least of its class)."""
    named = near_classes(docs, id_col=id_col, **how)
    size = named.groupBy("class").agg(F.count(F.lit(1)).alias("class_size")).select(
        F.xxhash64("class").alias("h"), F.col("class").alias("of"), "class_size")
    return (named.withColumn("h", F.xxhash64("class")).join(size, "h").where(F.col("class") == F.col("of"))
            .select(store.unkeyed("key.id").alias(id_col), store.unkeyed("class.id").alias("class_id"), "class_size",
                    (F.col("key") == F.col("class")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stand for their class, each document once; all columns stay."""
    kept = near_classes(docs, id_col=id_col, text_col=text_col, **how).where(F.col("key") == F.col("class")).select("key").distinct()
    row, rest = store.packed(docs)
    rows = docs.select(store.document_key(id_col, text_col).alias("key"), row)
    out = rows.join(kept, "key", "left_semi").dropDuplicates(["key"])
    return out.select(*(F.col("row")[c].alias(c) for c in rest))
