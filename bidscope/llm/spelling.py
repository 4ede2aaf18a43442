"""Spelling variants: words one edit apart, and the frequent form of each.

1. Words are counted: maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) with
   A-Z in lower case.  A tuneable share of the occurrences loses one letter first
   (``thin``), decided by the crc32 of id and run, so the rule is the same everywhere.
   Tasks count what they read before the counts are shuffled.
2. Words of one length (lengths from ``_LONG`` on together) share a Bloom filter, a
   shard: a word sets four bits in one 64-bit block of it.  Blocks are or-ed by Spark.
   Neighbouring shards are sent out together while they take at most ``max_filter_mb``,
   and a shard beyond that is cut by blocks; so the filters go out in as many rounds as
   that takes, and each round probes only what its shards can hold.
3. Every word probes its neighbourhood: all deletions, against the shard one shorter,
   and all replacements of a letter by a later one, against its own.  Insertions and
   the other replacements are the same pairs seen from the other word.  Hashes of
   edits follow from the word's hash, so no edit is written out unless its bits are
   all set.
4. Only positives are shuffled; the exact join with the vocabulary removes the false
   ones.  Each pair is found once and counted for both words.
5. A word's form is its most frequent near word (ties: the smaller) if that is
   ``ratio`` times as frequent; roots follow by pointer jumping on staged tables.

A word's near words are bounded by its length, so no group grows with the data.

Cases: null or empty texts have no words; a null id counts as an empty id text in the
thinning rule; repeated rows count as rows of their own; other columns are ignored,
whatever their names; an empty table gives an empty result; very long runs are words
like others.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K

U64 = np.uint64
_LONG = 64
_MULT = 0x9E3779B97F4A7C55
_SLICE = 4 << 20
_BITS_PER_WORD = 16
WORDS = "word string, n long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[ord("a"):ord("z") + 1] = True


def crc_table() -> np.ndarray:
    """What crc32 does to each byte."""
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(0xEDB88320), rows >> 1)
    return rows


def runs(off: np.ndarray, body: np.ndarray):
    """(row, start, end, lower-cased bytes) of the letter runs of a slice.

    In UTF-8 U+00C0 to U+00FF are the byte 0xC3 and one other byte.
    """
    low = _LOWER[body]
    lead = low == 0xC3
    letter = _ASCII_LETTER[low] | lead
    letter[1:] |= lead[:-1]
    gap = np.ones(256, bool)
    gap[1] = False
    starts, ends = K.spans(letter.astype(np.uint8), off, gap)
    return np.searchsorted(off, starts, "right") - 1, starts, ends, low


def crcs(seeds: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """crc32 of each span, going on from ``seeds`` (the crc32 of what stands before it)."""
    order = np.argsort(starts - ends, kind="stable")
    at, size = starts[order], (ends - starts)[order]
    state = seeds[order] ^ np.uint32(0xFFFFFFFF)
    active = np.searchsorted(-size, -np.arange(size[0]), "left") if len(size) else []
    for t, a in enumerate(active):
        now = state[:a]
        state[:a] = table[(now ^ low[at[:a] + t]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _count(least_length: int, thin: int):
    """(id, text) batches -> words and their counts in the task, merged as far as memory is bounded."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        table = crc_table()
        held, size = [], 0

        def merged():
            t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": t["word"], "n": t["n_sum"]})

        for batch in batches:
            ids = batch.column(0).cast(pa.string())
            names = [b"" if x is None else x.encode() for x in ids.to_pylist()]
            for a, b, off, body in K.slices(batch.column(1), _SLICE):
                row, starts, ends, low = runs(off, body)
                points = np.zeros(len(low) + 1, np.int64)
                np.cumsum((low & 0xC0) != 0x80, out=points[1:])
                long_ = points[ends] - points[starts] >= least_length
                row, starts, ends = row[long_], starts[long_], ends[long_]
                if not len(row):
                    continue
                seeds = np.array([zlib.crc32(x + b":") for x in names[a:b]], np.uint32)
                h = crcs(seeds[row], low, starts, ends, table)
                cut = h % np.uint32(thin) == 0 if thin else np.zeros(len(h), bool)
                extra = []
                for s, e, v in zip(starts[cut], ends[cut], h[cut].tolist()):
                    word = low[s:e].tobytes().decode()
                    if len(word) > least_length:
                        k = v % len(word)
                        extra.append(word[:k] + word[k + 1:])
                starts, ends = starts[~cut], ends[~cut]
                inside = np.zeros(len(low) + 1, np.int8)
                inside[starts] += 1
                inside[ends] -= 1
                data = low[np.cumsum(inside[:-1]).astype(bool)]
                places = np.zeros(len(starts) + 1, np.int64)
                np.cumsum(ends - starts, out=places[1:])
                words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data.tobytes()))
                for found in (words, pa.array(extra, pa.large_string())):
                    c = pc.value_counts(found)
                    held.append(pa.table({"word": c.field("values"), "n": c.field("counts")}))
                    size += held[-1].num_rows
                if size > 1 << 20:
                    held = [merged()]
                    if held[0].num_rows > 1 << 19:
                        yield from held.pop().cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)
                    size = sum(t.num_rows for t in held)
        if held:
            yield from merged().cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)
    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
                least_n: int = 5, thin: int = 199) -> DataFrame:
    """(word, n) of the words with at least ``least_length`` letters and ``least_n`` occurrences."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (texts.where("text is not null").mapInArrow(_count(least_length, thin), WORDS)
                 .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


# ---- hashes and filters ----------------------------------------------------------------

def by_length(words, limit: int):
    """Yield (which words, their code points as a matrix) for words of one length."""
    import pyarrow.compute as pc
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(size, kind="stable")
    edges = [0, *(np.flatnonzero(np.diff(size[order])) + 1).tolist(), len(order)]
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            continue
        length = int(size[order[a]])
        rows = max(1, limit // max(1, length))
        for s in range(a, b, rows):
            which = order[s:min(b, s + rows)]
            text = "".join(words.take(which).to_pylist())
            yield which, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(which), length)


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, U64), np.full(n, _MULT, U64)]))


def plain_hash(points: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Sum of (code point + 1) * multiplier ** place, so that edits follow by one addition."""
    return ((points.astype(U64) + U64(1)) * power[:points.shape[1]]).sum(1, dtype=U64)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each mixed hash, from its upper half."""
    return (((h >> U64(32)) * U64(blocks)) >> U64(32)).astype(np.int64)


def bits_of(h: np.ndarray) -> np.ndarray:
    """Four bits of a block, from the lower half."""
    one = U64(1)
    return (one << (h & U64(63))) | (one << ((h >> U64(6)) & U64(63))) | (one << ((h >> U64(12)) & U64(63))) | (one << ((h >> U64(18)) & U64(63)))


def shard_of(length: int) -> int:
    return min(length, _LONG)


def plan_rounds(counts: dict[int, int], max_words: int) -> tuple[dict[int, int], list[list[tuple[int, int, int]]]]:
    """(blocks of each shard, rounds of (shard, first block, end)) with at most ``max_words`` blocks a round."""
    blocks = {s: max(1, -(-n * _BITS_PER_WORD // 64)) for s, n in counts.items()}
    rounds, now, used = [], [], 0
    for shard in sorted(blocks):
        a = 0
        while a < blocks[shard]:
            take = min(blocks[shard] - a, max_words - used)
            now.append((shard, a, a + take))
            a, used = a + take, used + take
            if used == max_words:
                rounds.append(now)
                now, used = [], 0
    return blocks, rounds + ([now] if now else [])


def _blocks(blocks: dict[int, int]):
    """Words -> (shard, block, bits) of the filters."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, at, bits = (np.zeros(batch.num_rows, t) for t in (np.int32, np.int64, U64))
            for which, points in by_length(batch.column(0), 1 << 20):
                h = K.mix(plain_hash(points, powers(points.shape[1])))
                shard[which] = shard_of(points.shape[1])
                at[which] = block_of(h, blocks[shard_of(points.shape[1])])
                bits[which] = bits_of(h)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(at), pa.array(bits.view(np.int64))],
                                             names=["shard", "block", "bits"])
    return run


def _probe(shared, alphabet: np.ndarray, blocks: dict[int, int]):
    """Words -> their edits whose bits are all set in this round's filters."""
    def run(batches):
        import pyarrow as pa
        filters = {s: (first, bits) for s, first, bits in shared.value}

        def positive(shard, plain):
            """Which of the plain hashes may be words of the shard, as far as this round holds it."""
            first, bits = filters[shard]
            h = K.mix(plain)
            at = block_of(h, blocks[shard]) - first
            here = (at >= 0) & (at < len(bits)) if len(bits) < blocks[shard] else None
            want = bits_of(h)
            if here is None:
                return (bits[at] & want) == want
            return here & ((bits[np.where(here, at, 0)] & want) == want)

        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0)
            word_at, edits = [], []
            for which, points in by_length(words, 1 << 13):
                n, size = points.shape
                power = powers(size + 1)
                plain = plain_hash(points, power)
                if size > 1 and shard_of(size - 1) in filters:
                    # Without letter i: what stands before it, and what follows one place lower.
                    terms = (points.astype(U64) + U64(1)) * power[:size]
                    before = np.zeros((n, size + 1), U64)
                    np.cumsum(terms, axis=1, out=before[:, 1:])
                    lower = (points.astype(U64) + U64(1))[:, 1:] * power[:size - 1]
                    after = np.zeros((n, size), U64)
                    after[:, :-1] = np.cumsum(lower[:, ::-1], axis=1)[:, ::-1]
                    hit = positive(shard_of(size - 1), before[:, :size] + after)
                    hit[:, 1:] &= points[:, 1:] != points[:, :-1]     # of a double letter one is enough
                    for r, i in zip(*np.nonzero(hit)):
                        p = points[r]
                        word_at.append(which[r])
                        edits.append(np.delete(p, i).tobytes().decode("utf-32-le"))
                if shard_of(size) in filters:
                    for i in range(size):
                        step = (alphabet.astype(U64)[None, :] - points[:, i].astype(U64)[:, None]) * power[i]
                        hit = positive(shard_of(size), plain[:, None] + step)
                        hit &= alphabet[None, :] > points[:, i][:, None]
                        for r, c in zip(*np.nonzero(hit)):
                            p = points[r].copy()
                            p[i] = alphabet[c]
                            word_at.append(which[r])
                            edits.append(p.tobytes().decode("utf-32-le"))
            if edits:
                take = np.array(word_at)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(take)), batch.column(1).take(pa.array(take)),
                                                  pa.array(edits, pa.string())], names=["word", "n", "edit"])
    return run


def near_pairs(vocabulary: DataFrame, max_filter_mb: float = 32) -> DataFrame:
    """(word, n, near, near_n): each pair of words one edit apart, once."""
    spark = vocabulary.sparkSession
    tasks = store.shuffle_partitions(spark)
    lengths = vocabulary.groupBy(F.least(F.length("word"), F.lit(_LONG)).alias("shard")).count().collect()
    letters = np.array(sorted(r[0] for r in vocabulary.select(
        F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").select(F.ascii("c").alias("c")).distinct().collect()), np.uint32)
    blocks, rounds = plan_rounds({r["shard"]: r["count"] for r in lengths}, max(1, int(max_filter_mb * (1 << 17))))
    filters = store.staged(vocabulary.mapInArrow(_blocks(blocks), "shard int, block long, bits long")
                           .groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")), "filters")
    found = None
    for parts in rounds:
        shards = {s for s, _, _ in parts}
        here = F.lit(False)
        for shard, a, b in parts:
            here = here | ((F.col("shard") == shard) & (F.col("block") >= a) & (F.col("block") < b))
        got = filters.where(here).toArrow()
        of, at, value = (got[c].to_numpy() for c in ("shard", "block", "bits"))
        arrays = []
        for shard, a, b in parts:
            bits, own = np.zeros(b - a, U64), of == shard
            bits[at[own] - a] = value[own].view(U64)
            arrays.append((shard, a, bits))
        probes = shards | {s + 1 for s in shards}
        probing = vocabulary.where(F.least(F.length("word"), F.lit(_LONG)).isin(sorted(probes)))
        hits = probing.repartition(tasks).mapInArrow(_probe(spark.sparkContext.broadcast(arrays), letters, blocks),
                                                "word string, n long, edit string")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return vocabulary.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    known = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    return found.join(known, "edit").select("word", "n", F.col("edit").alias("near"), "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: forms followed to the last, by pointer jumping.

    A form is ``ratio`` times as frequent as its word, so there are no cycles.
    """
    points = store.staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = points.select(F.col("word").alias("root"), F.col("root").alias("far"))
        jumped = store.staged(points.join(far, "root", "left")
                              .select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        moved = not jumped.where("moved").isEmpty()
        store.drop_staged(points)
        points = jumped.select("word", "root")
        if not moved:
            return points


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
                      least_n: int = 5, thin: int = 199, ratio: int = 5, max_filter_mb: float = 32) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = store.staged(count_words(docs, id_col, text_col, least_length, least_n, thin), "words")
    pairs = near_pairs(words, max_filter_mb)
    both = pairs.select(F.explode(F.array(
        F.struct("word", F.col("near").alias("near"), F.col("near_n").alias("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    frequent = -F.col("best.rank") >= F.lit(ratio) * F.col("n")
    told = store.staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.rank")).alias("form_n")), "forms")
    last = roots(told.where("form is not null"))
    return (told.join(last, "word", "left")
                .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
