"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

1. Every text is encoded by both tokenizers once; the ids are staged as packed arrays,
   so that the later passes re-align them without encoding again.  A document has
   tokens only if both sequences spell a space and the text, byte for byte.
2. Byte offsets where tokens of both sides end cut a document into groups.  Each
   stretch between neighbouring ends of either side is one link: an occurrence of the
   first side's token and one of the second's that overlap.
3. The distinct pairs of ids that are linked anywhere are gathered by Spark (distinct
   within the task first).  Their number is bounded by the vocabularies, not the data.
4. A minimal perfect hash numbers them: pairs are dealt to shards of some 2**16, and
   each shard sets one bit a pair, level by level, where no other pair of the level
   falls on the same bit; a pair's number is the rank of its bit.
5. Every task counts documents per pair in one dense vector by that number; the vectors
   are summed as a tree, in blocks (``sums.tree_summed``).
6. The second pass aligns the staged ids again, looks up each link's count, and checks
   every pair against the key stored at its number.

Numbers, keys and counts of one round take at most ``max_table_mb``; with more pairs the
first side's ids are cut into ranges, one round each, and the rounds' sums are added by
document.  Documents are rows: a repeated row counts again.

Cases: null and empty texts, and texts that one side does not spell exactly, have no
tokens: zeros and an empty ``groups_sha256``; strings of special tokens are plain text; a
null id stays null; other columns are ignored, whatever their names; an empty table
gives an empty result.  A document is aligned as a whole in one task, at some 100 bytes
of memory a token.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, sums, textkernels as K
from bidscope.llm.packing import Encoder, byte_ranks

U64 = np.uint64
_SHARD = 1 << 16
_SLICE_TOKENS = 1 << 18
_SLICE_BYTES = 8 << 20
SHAPE = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "


class ByteLevel(Encoder):
    """First side: byte-level BPE of a space and the text, special strings as plain text."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        ranks, special = byte_ranks(vocabulary)
        self.spell = {i: token for token, i in ranks.items()}
        self.size = max(self.spell) + 1 + len(special)
        self.high = re.compile("[\u2000-\U0010ffff]")   # from here on the two libraries' tables may differ

    def __call__(self, text: str) -> list[int]:
        if not self.high.search(text):
            return self.fast.encode_ordinary(" " + text)
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.vocabulary)
            self.slow.encode_special_tokens = True
        return self.slow.encode(" " + text, add_special_tokens=False).ids


class SentencePieces:
    """Second side: pieces of the text; the model adds the space."""

    def __init__(self, model: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = self.model.get_piece_size()
        self.spell = {}
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            self.spell[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text: str) -> list[int]:
        return self.model.encode(text)


_UNITS = 1 << 17


class Units:
    """Packed ids of both sides, by unit: a space and what follows up to the next space.

    Where every space stands before a character that is no white space, neither side has a
    token across the start of a unit: the byte-level pattern begins a pre-token there, and no
    piece has a space after another character (checked).  So units are encoded once and
    remembered; those not met among the last ``_UNITS`` or so are forgotten.  Other texts are
    encoded whole.
    """

    def __init__(self, first: str, second: str):
        self.sides = ByteLevel(first), SentencePieces(second)
        self.kind = "I" if max(side.size for side in self.sides) > 1 << 16 else "H"
        self.apart = not any(b" " in x.lstrip(b" ") for x in self.sides[1].spell.values())
        self.odd = re.compile(r"(?:^| )(?:\s|$)")
        self.sizes = [spelled_lengths(side.spell) for side in self.sides]
        self.known: dict = {}
        self.old: dict = {}

    def packed(self, text: str) -> list[bytes | None]:
        """Both sides' ids as bytes, or None twice if one side does not spell a space and the text."""
        want, ids = b" " + text.encode(), [side(text) for side in self.sides]
        if any(b"".join(map(side.spell.__getitem__, x)) != want for side, x in zip(self.sides, ids)):
            return [None, None]
        return [array(self.kind, x).tobytes() for x in ids]

    def learn(self, units: list[str]) -> None:
        """All units in a row, cut where they end; one by one if a side does not spell them so."""
        text = " ".join(units)
        size = np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))
        blobs = []
        for side, sizes in zip(self.sides, self.sizes):
            ids = side(text)
            if b"".join(map(side.spell.__getitem__, ids)) != b" " + text.encode():
                break
            flat = array(self.kind, ids)
            ends = np.cumsum(sizes[np.frombuffer(flat, flat.typecode)])
            cut = np.searchsorted(ends, np.cumsum(size)) + 1
            if (ends[cut - 1] != np.cumsum(size)).any():
                break
            data, cut = flat.tobytes(), (np.concatenate([[0], cut]) * flat.itemsize).tolist()
            blobs.append([data[x:y] for x, y in zip(cut[:-1], cut[1:])])
        self.known.update(zip(units, zip(*blobs) if len(blobs) == 2 else map(self.packed, units)))

    def of(self, units: list[str]) -> list:
        """(first side's ids, second side's ids) of distinct units."""
        if len(self.known) > _UNITS:
            self.old, self.known = self.known, {}
        known = self.known
        new = []
        for u in [u for u in units if u not in known]:
            if u in self.old:
                known[u] = self.old[u]
            else:
                new.append(u)
        high, groups = self.sides[0].high, [new]
        if high.search(" ".join(new)):       # these go to another library, so apart
            groups = [[u for u in new if not high.search(u)], [u for u in new if high.search(u)]]
        for some in groups:
            for i in range(0, len(some), 1 << 14):
                self.learn(some[i:i + (1 << 14)])
        return [known[u] for u in units]

    def encode(self, texts) -> tuple[list, list]:
        """Both sides' (offsets in bytes, packed ids) of an Arrow array of texts."""
        import pyarrow as pa
        import pyarrow.compute as pc
        rows = texts.to_pylist()
        by_unit = np.array([bool(t) and self.apart and not self.odd.search(t) for t in rows], bool)
        lists = pc.split_pattern(pc.if_else(pa.array(by_unit), pc.fill_null(texts, ""), ""), " ")
        coded = lists.flatten().dictionary_encode()
        pairs = self.of(coded.dictionary.to_pylist())
        cut = lists.offsets.to_numpy().astype(np.int64)
        cut -= cut[0]
        codes = coded.indices.to_numpy()
        unknown = np.array([p[0] is None for p in pairs], bool)[codes]
        bad = np.add.reduceat(np.append(unknown, False).astype(np.int64), cut[:-1]) > 0 if len(cut) > 1 else np.zeros(0, bool)
        use = np.repeat(by_unit & ~bad, np.diff(cut))
        whole = {r: self.packed(rows[r]) for r in np.flatnonzero(~by_unit).tolist() if rows[r]}
        out = []
        width = array(self.kind).itemsize
        for k in range(2):
            blobs = [p[k] or b"" for p in pairs]
            data = np.frombuffer(b"".join(blobs), f"<u{width}")
            size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // width
            first = np.cumsum(size) - size
            n = size[codes] * use
            total = np.concatenate([[0], np.cumsum(n)])
            ids = data[np.repeat(first[codes] - total[:-1], n) + np.arange(total[-1])]
            off = total[cut] * width
            if any(x[k] for x in whole.values()):
                body, parts = ids.tobytes(), []
                for r in range(len(rows)):
                    parts.append(whole[r][k] or b"" if r in whole else body[off[r]:off[r + 1]])
                off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
                ids = np.frombuffer(b"".join(parts), f"<u{width}")
            out.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(ids.tobytes())]))
        return out


def _encode(first: str, second: str):
    """(id, text) -> (id, first side's ids, second side's ids), empty where a side differs from the text."""
    def run(batches):
        import pyarrow as pa
        units = Units(first, second)
        for batch in batches:
            for s, e, _, _ in K.slices(batch.column(1), _SLICE_BYTES):
                part = batch.slice(s, e - s)
                a, b = units.encode(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), a, b], names=["doc_id", "a", "b"])
    return run


def spelled_lengths(spell: dict[int, bytes]) -> np.ndarray:
    out = np.ones(max(spell) + 1, np.int64)
    for i, token in spell.items():
        out[i] = len(token)
    return out


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0..n-1, left-aligned, and how many each has."""
    width = len(str(max(n - 1, 0)))
    text = np.char.mod("%d", np.arange(n)).astype(f"S{width}")
    return text.view(np.uint8).reshape(n, width), np.char.str_len(text).astype(np.int64)


class Aligned:
    """The links of a slice of documents whose two sides spell the same bytes."""

    def __init__(self, a: np.ndarray, off_a: np.ndarray, b: np.ndarray, off_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray):
        self.a, self.b, self.off_a, self.off_b = a, b, off_a, off_b
        self.n = len(off_a) - 1
        self.end_a, self.end_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
        total = int(self.end_a[-1]) if len(a) else 0
        ends_a, ends_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        ends_a[self.end_a] = True
        ends_b[self.end_b] = True
        stretch = np.flatnonzero(ends_a | ends_b)
        self.at_a = (np.cumsum(ends_a, dtype=np.int32)[stretch] - ends_a[stretch]).astype(np.int64)
        self.at_b = (np.cumsum(ends_b, dtype=np.int32)[stretch] - ends_b[stretch]).astype(np.int64)
        self.common = ends_a & ends_b
        self.doc = np.repeat(np.arange(self.n), np.diff(off_a))[self.at_a]
        self.width = len(len_a).bit_length(), len(len_b).bit_length()
        self.pair = (a[self.at_a].astype(np.int64) << self.width[1]) | b[self.at_b].astype(np.int64)

    def links(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)

    def distinct(self) -> np.ndarray:
        return np.unique(self.pair)

    def per_document(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct pairs, in how many documents of the slice)."""
        bits = sum(self.width)
        key = np.sort((self.doc << bits) | self.pair)
        once = np.ones(len(key), bool)
        once[1:] = key[1:] != key[:-1]
        return np.unique(key[once] & ((1 << bits) - 1), return_counts=True)

    def groups(self, digits_a, digits_b) -> tuple[np.ndarray, list[str]]:
        """Groups of each document, and the sha256 of them as written text."""
        done = np.cumsum(self.common)
        last_a, last_b = self.common[self.end_a], self.common[self.end_b]
        group_a, group_b = done[self.end_a] - last_a, done[self.end_b] - last_b
        before_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])    # tokens before each group
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        place_a = np.arange(len(self.a)) + before_b[group_a]
        place_b = np.arange(len(self.b)) + before_a[group_b + 1]
        size = np.empty(len(self.a) + len(self.b), np.int64)
        size[place_a], size[place_b] = digits_a[1][self.a] + 1, digits_b[1][self.b] + 1
        ends = np.cumsum(size)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        for ids, place, (digits, width), last, sign in ((self.a, place_a, digits_a, last_a, b"|"), (self.b, place_b, digits_b, last_b, b";")):
            start, w = ends[place] - size[place], width[ids]
            for d in range(digits.shape[1]):
                has = w > d
                out[start[has] + d] = digits[ids[has], d]
            out[ends[place] - 1] = np.where(last, np.uint8(sign[0]), np.uint8(ord(",")))
        text, cut = out.tobytes(), np.concatenate([[0], ends])[self.off_a + self.off_b]
        shas = [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
        group_ends = np.concatenate([[0], np.cumsum(last_a)])[self.off_a]
        return np.diff(group_ends), shas


def _unpacked(col, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, offsets of the rows) of a binary column of packed ids, not copied."""
    off, body = K.buffers(col)
    return body.view(dtype), off // np.dtype(dtype).itemsize


def _slices(batch, dtype: str, len_a: np.ndarray, len_b: np.ndarray):
    """Yield (first row, end, links) of the rows of a batch, some ``_SLICE_TOKENS`` tokens at a time."""
    a, off_a = _unpacked(batch.column("a"), dtype)
    b, off_b = _unpacked(batch.column("b"), dtype)
    s, n = 0, batch.num_rows
    while s < n:
        e = min(n, max(s + 1, int(np.searchsorted(off_a, off_a[s] + _SLICE_TOKENS, "right")) - 1))
        yield s, e, Aligned(a[off_a[s]:off_a[e]], off_a[s:e + 1] - off_a[s], b[off_b[s]:off_b[e]], off_b[s:e + 1] - off_b[s], len_a, len_b)
        s = e


def _pairs(dtype: str, len_a: np.ndarray, len_b: np.ndarray):
    """The distinct pairs of a task."""
    def run(batches):
        import pyarrow as pa
        held, size = [], 0
        for batch in batches:
            for _, _, links in _slices(batch, dtype, len_a, len_b):
                held.append(links.distinct())
                size += len(held[-1])
                if size > 1 << 22:
                    held = [np.unique(np.concatenate(held))]
                    size = len(held[0])
                    if size > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0])], names=["pair"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["pair"])
    return run


# ---- minimal perfect hash ----------------------------------------------------------------

def level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return K.mix(keys.astype(U64) * U64(0x9E3779B97F4A7C15) + U64((2 * level + 1) * 0xD1B54A32D192ED03 % (1 << 64)))


def scaled(h: np.ndarray, size) -> np.ndarray:
    return (((h >> U64(32)) * np.asarray(size).astype(U64)) >> U64(32)).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return scaled(level_hash(keys, -1), shards)


def hash_levels(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(bits of each level, all levels' bits as 64-bit words): one bit a key, each alone on its level's place."""
    sizes, words, level = [], [], 0
    while len(keys):
        size = -(-2 * len(keys) // 64) * 64
        at = scaled(level_hash(keys, level), size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(U64))
        sizes.append(size)
        keys = keys[~alone[at]]
        level += 1
    return sizes, np.concatenate(words) if words else np.zeros(0, U64)


def _shard_levels(rows):
    import pandas as pd
    sizes, words = hash_levels(np.sort(rows["pair"].to_numpy()))
    return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "sizes": [np.array(sizes, np.int64).tobytes()], "words": [words.tobytes()]})


class Numbering:
    """Number of each key from 0 on, without gaps; -1 for some keys that were not given."""

    def __init__(self, arrays: dict):
        vars(self).update(arrays)

    @classmethod
    def of(cls, rows: list, shards: int) -> Numbering:
        rows = {r["shard"]: r for r in rows}
        sizes = [np.frombuffer(rows[s]["sizes"], np.int64) if s in rows else np.zeros(0, np.int64) for s in range(shards)]
        words = [np.frombuffer(rows[s]["words"], U64) for s in range(shards) if s in rows]
        self = cls({})
        self.shards, self.levels = shards, max(map(len, sizes), default=0)
        self.size = np.zeros((self.levels + 1, shards), np.int64)
        self.first = np.zeros((self.levels + 1, shards), np.int64)
        at = 0
        for s, own in enumerate(sizes):
            self.size[:len(own), s] = own
            self.first[:len(own), s] = at + np.cumsum(own) - own
            at += int(own.sum())
        self.words = np.concatenate([*words, np.zeros(1, U64)])
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        return self

    def __len__(self) -> int:
        return int(self.rank[-1])

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, shard, one = np.arange(len(keys)), shard_of(keys, self.shards), U64(1)
        for level in range(self.levels):
            size = self.size[level][shard]
            known = size > 0
            left, shard, size = left[known], shard[known], size[known]
            bit = self.first[level][shard] + scaled(level_hash(keys[left], level), size)
            word, inside = self.words[bit >> 6], (bit & 63).astype(U64)
            hit = ((word >> inside) & one).astype(bool)
            below = np.bitwise_count(word & ((one << inside) - one))
            out[left[hit]] = (self.rank[bit >> 6] + below)[hit]
            left, shard = left[~hit], shard[~hit]
        return out


def _in_range(pairs: np.ndarray, lo: int, hi: int, bits: int) -> np.ndarray:
    first = pairs >> bits
    return (first >= lo) & (first < hi)


def _count(dtype: str, len_a, len_b, shared, lo: int, hi: int):
    """Documents per pair, as this task's dense vector in blocks."""
    def run(batches):
        from pyspark import TaskContext
        number = Numbering(shared.value)
        total = np.zeros(len(number), np.int64)
        for batch in batches:
            for _, _, links in _slices(batch, dtype, len_a, len_b):
                kinds, docs = links.per_document()
                use = _in_range(kinds, lo, hi, links.width[1])
                total[number(kinds[use])] += docs[use]
        yield from sums.dense_rows(total, TaskContext.get().partitionId())
    return run


def _numbered(shared):
    def run(batches):
        import pyarrow as pa
        number = Numbering(shared.value)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number(keys))], names=["pair", "place"])
    return run


def _look_up(dtype: str, len_a, len_b, shared, table, lo: int, hi: int, whole: bool, digits):
    """Counts of the links of every document; with ``whole`` all that does not need them as well."""
    def run(batches):
        import pyarrow as pa
        number = Numbering(shared.value)
        keys, counts, top = table.value
        for batch in batches:
            found = []
            for s, e, links in _slices(batch, dtype, len_a, len_b):
                kinds, kind = np.unique(links.pair, return_inverse=True)
                use = _in_range(kinds, lo, hi, links.width[1])
                place = number(kinds[use])
                if (place < 0).any() or (keys[place] != kinds[use]).any():
                    raise ValueError("a pair was not numbered")
                count, best = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), bool)
                count[use], best[use] = counts[place], top[place]
                n_best = np.bincount(links.doc[best[kind]], minlength=e - s)
                total = np.zeros(e - s, np.int64)
                np.add.at(total, links.doc, count[kind])
                more = []
                if whole:
                    n_groups, shas = links.groups(*digits)
                    more = [np.diff(links.off_a), np.diff(links.off_b), n_groups, links.links(), np.array(shas, object)]
                found.append((*more, n_best, total))
            cols = [np.concatenate(x) for x in zip(*found)]
            rest = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if c.dtype == object else pa.int64()) for c in cols],
                names=[*(["n_a", "n_b", "n_groups", "n_links", "groups_sha256"] if whole else []), "n_best", "count_sum"])
            key = ["row", "doc_id"] if whole else ["row"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in key), *rest.columns], names=[*key, *rest.schema.names])
    return run


def id_ranges(per_id: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of ids with at most ``limit`` pairs each (an id of more stands alone)."""
    out, lo, used = [], 0, 0
    for i, n in enumerate(per_id.tolist()):
        if used and used + n > limit:
            out.append((lo, i))
            lo, used = i, 0
        used += n
    return [*out, (lo, len(per_id))]


def align_tokenizers(docs: DataFrame, first: str, second: str, max_table_mb: float = 192,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``first`` is a byte-level BPE file, ``second`` a sentencepiece model.
    """
    spark = docs.sparkSession
    side_a, side_b = ByteLevel(first), SentencePieces(second)
    dtype = "<u4" if max(side_a.size, side_b.size) > 1 << 16 else "<u2"
    len_a, len_b = spelled_lengths(side_a.spell), spelled_lengths(side_b.spell)
    digits = decimals(len(len_a)), decimals(len(len_b))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    tokens = store.staged(texts.mapInArrow(_encode(first, second), f"doc_id {kind}, a binary, b binary")
                          .withColumn("row", F.monotonically_increasing_id()), "tokens")
    ids = tokens.select("a", "b")
    pairs = store.staged(ids.mapInArrow(_pairs(dtype, len_a, len_b), "pair long").distinct(), "pairs")
    per_id, bits = np.zeros(len(len_a), np.int64), len(len_b).bit_length()
    id_a = F.shiftright("pair", bits)
    for r in pairs.groupBy(id_a.alias("id")).count().collect():   # bounded by the vocabulary
        per_id[r["id"]] = r["count"]
    out = None
    for k, (lo, hi) in enumerate(id_ranges(per_id, max(1, int(max_table_mb * (1 << 16))))):
        part = pairs.where((id_a >= lo) & (id_a < hi))
        shards = max(1, -(-int(per_id[lo:hi].sum()) // _SHARD))
        dealt = part.mapInArrow(_sharded(shards), "pair long, shard int")
        built = dealt.groupBy("shard").applyInPandas(_shard_levels, "shard int, sizes binary, words binary").collect()
        number = Numbering.of(built, shards)
        shared = spark.sparkContext.broadcast(vars(number))
        vectors = _for_vectors(ids, 8 * len(number)).mapInArrow(_count(dtype, len_a, len_b, shared, lo, hi), sums.DENSE)
        counts = sums.tree_summed(vectors, len(number))
        keys = np.full(len(number), -1, np.int64)
        got = part.mapInArrow(_numbered(shared), "pair long, place long").toArrow()
        keys[got["place"].to_numpy()] = got["pair"].to_numpy()
        most = np.zeros(len(len_a), np.int64)
        np.maximum.at(most, keys >> bits, counts)
        table = spark.sparkContext.broadcast((keys, counts, counts == most[keys >> bits]))
        whole = k == 0
        shape = ("row long, " + (SHAPE.format(kind=kind) if whole else "") + "n_best long, count_sum long")
        read = tokens.select("row", "doc_id", "a", "b") if whole else tokens.select("row", "a", "b")
        found = read.mapInArrow(_look_up(dtype, len_a, len_b, shared, table, lo, hi, whole, digits), shape)
        out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if k:
        once = [F.max(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
        out = out.groupBy("row").agg(*once, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.withColumnRenamed("doc_id", id_col).select(*names)


def _sharded(shards: int):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            shard = shard_of(batch.column(0).to_numpy(), shards).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard)], names=["pair", "shard"])
    return run


def _for_vectors(ids: DataFrame, vector_bytes: int) -> DataFrame:
    """The ids in tasks that read several times the size of their vector, so that the
    vectors stay a small part of what is moved."""
    have = ids.rdd.getNumPartitions()
    want = max(ids.sparkSession.sparkContext.defaultParallelism, store.size_of(ids) // (4 * max(1, vector_bytes)))
    return ids.coalesce(int(want)) if want < have else ids
