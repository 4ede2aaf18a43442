"""Token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a space and a run of bytes outside ``[\\x20\\x09-\\x0D]``, at most
``max_pretoken`` bytes of it (longer runs are split).  Its tokens are the
segmentation into pieces of a public byte-level vocabulary with the best sum of
unigram scores; of equal sums the one with fewer tokens.

The pre-tokens of a slice of texts are made distinct by hash and put into a trie,
level by level.  The best score of a node needs only its ancestors' scores, as
they are its shorter prefixes, so a shared prefix is scored once for all its
words.  A word's count is read at its terminal node, and a text's count is the sum
over its words.

Scores are fixed by the file: piece number i has -ln(i + 2) in millionths, an
integer, so sums are exact and equal on every host.  The vocabulary holds all 256
bytes, so every text has a segmentation.

Cases: null or empty text has no tokens; repeated rows count alike; other columns
stay, unless they bear a result's name, which the result then takes.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.llm import store, textkernels as K
from bidscope.llm.packing import byte_ranks

U64 = np.uint64
_B = U64(0x9E3779B97F4A7C55)
_MICRO, _TIE = 1_000_000, 1 << 12
_BITS = 20


class Pieces:
    """Vocabulary as sorted hashes with the value of each piece.

    A value is ``_TIE`` times the score, less one for the token itself: sums of values
    order by score first and by fewer tokens second.
    """

    def __init__(self, pieces: dict[bytes, int], max_pretoken: int):
        use = {p: i for p, i in pieces.items() if len(p) <= max_pretoken + 1}
        h = np.array([self.hash(p) for p in use], U64)
        order = np.argsort(h)
        self.known = h[order]
        if (np.diff(self.known) == 0).any():
            raise ValueError("two pieces share a hash")
        self.value = np.array([-round(math.log(i + 2) * _MICRO) * _TIE - 1 for i in use.values()], np.int64)[order]
        self.longest = max(map(len, use))
        self.lengths = sorted({len(p) for p in use})
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(self.known >> U64(64 - _BITS)).astype(np.int64)] = True

    @staticmethod
    def hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_B) + b + 1) % (1 << 64)
        return h

    def find(self, h: np.ndarray):
        """(which, value) of the hashes that are pieces."""
        near = np.flatnonzero(self.bitmap[(h >> U64(64 - _BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, h[near]), len(self.known) - 1)
        hit = self.known[at] == h[near]
        return near[hit], self.value[at[hit]]


def pretokens(off: np.ndarray, body: np.ndarray, longest: int):
    """(row, start, end) of the pre-tokens, without their space."""
    starts, ends = K.spans(body, off)
    parts = -(-(ends - starts) // longest)
    if len(parts) and parts.max() > 1:
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, ends = np.repeat(starts, parts) + k * longest, np.repeat(ends, parts)
        ends = np.minimum(ends, starts + longest)
    return np.searchsorted(off, starts, "right") - 1, starts, ends


def trie_counts(letters: np.ndarray, size: np.ndarray, pieces: Pieces):
    """(tokens, score) of distinct words given as padded byte rows, level by level."""
    n, power = len(size), [U64(1)]
    with np.errstate(over="ignore"):
        for _ in range(pieces.longest):
            power.append(power[-1] * _B)
    node = np.zeros((n, 1), np.int64)                     # each word's node on every level
    value, hashes = [np.zeros(1, np.int64)], [np.zeros(1, U64)]
    path, final = [node[:, 0]], np.zeros(n, np.int64)
    alive = np.arange(n)
    for depth in range(1, int(size.max()) + 1 if n else 0):
        alive = alive[size[alive] >= depth]
        edge = path[-1][alive] * 256 + letters[alive, depth - 1]
        _, first, at = np.unique(edge, return_index=True, return_inverse=True)
        rep = alive[first]                                # one word through each new node
        h = hashes[-1][path[-1][rep]] * _B + letters[rep, depth - 1].astype(U64) + U64(1)
        best = np.full(len(rep), np.iinfo(np.int64).min)
        for k in pieces.lengths:
            if k > depth:
                break
            up = path[depth - k][rep]                     # the prefix before the last k bytes
            i, v = pieces.find(h - hashes[depth - k][up] * power[k])
            best[i] = np.maximum(best[i], value[depth - k][up[i]] + v)
        mine = np.zeros(n, np.int64)
        mine[alive] = at
        path.append(mine)
        value.append(best)
        hashes.append(h)
        end = alive[size[alive] == depth]
        final[end] = best[mine[end]]
    tokens = -final % _TIE
    return tokens, (final + tokens) // _TIE


def _count(vocabulary, max_pretoken: int):
    def run(batches):
        import pyarrow as pa
        pieces = Pieces(vocabulary.value, max_pretoken)
        for batch in batches:
            out = [np.zeros((3, 0), np.int64)]
            for a, b, off, body in K.slices(batch.column(0), 4 << 20):
                row, starts, ends = pretokens(off, body, max_pretoken)
                h = K.span_hashes(K.byte_sums(body), starts, ends)
                _, first, at = np.unique(h, return_index=True, return_inverse=True)
                size = ends[first] - starts[first]
                place = np.minimum(starts[first][:, None] + np.arange(int(size.max()) if len(size) else 0)[None, :],
                                   max(len(body) - 1, 0))
                letters = np.concatenate([np.full((len(size), 1), 32, np.uint8), body[place]], axis=1)
                tokens, score = trie_counts(letters, size + 1, pieces)
                got = np.zeros((3, b - a), np.int64)
                for i, x in enumerate((np.ones(len(first), np.int64), tokens, score)):
                    np.add.at(got[i], row, x[at])
                out.append(got)
            got = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x) for x in got)],
                                             names=["row", "n_pretokens", "n_tokens", "micro_score"])
    return run


def token_counts(docs: DataFrame, vocabulary: str, max_pretoken: int = 64, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_pretokens, n_tokens and micro_score (the sum
    of the chosen pieces' scores, in millionths)."""
    pieces, _ = byte_ranks(vocabulary)
    known = docs.sparkSession.sparkContext.broadcast(pieces)      # the vocabulary file, a fixed size
    new = ["n_pretokens", "n_tokens", "micro_score"]
    row, rest = store.packed(docs, [text_col, *new])
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), row)
    shape = rows.select("row").schema
    for c in new:
        shape = shape.add(c, "long")
    return rows.mapInArrow(_count(known, max_pretoken), shape).select(*[F.col("row")[c].alias(c) for c in rest], *new)
