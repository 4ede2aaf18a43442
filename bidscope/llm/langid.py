"""Language of texts by cross-parsing against suffix automata.

1. Per language, labelled texts in the order of their hash, each different text once,
   are folded and joined up to ``reference_bytes``; all languages together take at most
   about ``total_bytes``.  This sample of labelled rows is the only bound.
2. One task per language builds the suffix automaton of its reference: every substring
   of it is a path from the root.
3. Every text is parsed greedily by every automaton: a phrase is the longest match from
   its first byte on; a byte that the reference lacks is a phrase of its own.  Texts
   are parsed in blocks of ``_BLOCK`` bytes, whole, and a phrase ends with its block.
4. Phrases times log2 of the reference's size, per byte, estimate the cross entropy
   (Ziv and Merhav); the language with the least wins.  Ties go to the language whose
   phrases occur more often in its reference, then to the one with more labelled rows.

The score is second / (least + second) of these entropies: 0.5 for a tie, 1.0 when one
language alone was learned.  Folding takes letters to lower case, and runs of ASCII
characters other than letters to one space.

The automata are read in lockstep, all blocks of a slice times all languages at once.
A state keeps a bit set of its symbols; the place of a transition is the state's first
place plus the number of set bits below the symbol.

Cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text when nothing was learned; null languages are not learned; rows that repeat
are predicted alike; a null id stays null; other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm import textkernels as K

UNDETERMINED = "und"
_BLOCK = 1024
_SLICE = 4 << 20
_LETTERS = np.zeros(256, bool)
_LETTERS[ord("a"):ord("z") + 1] = True
_LETTERS[128:] = True
AUTOMATON = "lang string, size long, keys binary, targets binary, occurs binary"


def folded(off: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of lower-case texts with one space for each run of other bytes."""
    solid = _LETTERS[body]
    keep = solid.copy()
    if len(body):
        first = np.zeros(len(body) + 1, bool)
        first[off] = True
        keep[1:] |= solid[:-1] & ~first[1:-1]
    places = np.zeros(len(body) + 1, np.int64)
    np.cumsum(keep, out=places[1:])
    return places[off], np.where(solid, body, np.uint8(32))[keep]


def suffix_automaton(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state * 256 + byte of each transition, sorted; its target; occurrences of each state)."""
    step: list[dict[int, int]] = [{}]
    link, length, occurs = [-1], [0], [0]
    last = 0
    for c in text:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        occurs.append(1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] != length[p] + 1:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                occurs.append(0)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
            else:
                link[new] = q
        last = new
    for s in np.argsort(np.array(length), kind="stable")[:0:-1].tolist():
        occurs[link[s]] += occurs[s]
    keys = np.array([(s << 8) | c for s, to in enumerate(step) for c in to], np.int64)
    targets = np.array([t for to in step for t in to.values()], np.int32)
    order = np.argsort(keys)
    return keys[order], targets[order], np.array(occurs, np.int32)


def _build(limit: int):
    """A language's texts -> its automaton."""
    def run(rows):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc
        rows = rows.sort_values(["h", "text"])
        off, body = folded(*K.buffers(pc.utf8_lower(pa.array(rows["text"], pa.large_string()))))
        parts = [body[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
        text = b"\0".join(parts)[:limit]
        keys, targets, occurs = suffix_automaton(text)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "size": [len(text)], "keys": [keys.tobytes()],
                             "targets": [targets.tobytes()], "occurs": [occurs.tobytes()]})
    return run


class Automata:
    """The automata of all languages in one space of states.

    Only the arrays (``vars``) are broadcast, as executors may lack this package.
    """

    def __init__(self, arrays: dict):
        vars(self).update(arrays)

    @classmethod
    def of(cls, rows: list, prior: dict[str, int]) -> Automata:
        self = cls({})
        rows = sorted(rows, key=lambda r: (-prior[r["lang"]], r["lang"]))
        self.langs = [r["lang"] for r in rows]
        self.log_size = np.array([np.log2(r["size"] + 2) for r in rows])
        keys = [np.frombuffer(r["keys"], np.int64) for r in rows]
        occurs = [np.frombuffer(r["occurs"], np.int32) for r in rows]
        ends = np.cumsum([0, *(len(o) for o in occurs)])
        self.roots = ends[:-1].astype(np.int32)
        symbols = np.unique(np.concatenate([k & 255 for k in keys])) if keys else np.zeros(0, np.int64)
        #: Class of each byte; the last class stands for bytes that no reference has.
        self.symbol = np.full(256, len(symbols), np.uint16)
        self.symbol[symbols] = np.arange(len(symbols))
        self.width = len(symbols) // 64 + 1
        state = np.concatenate([(k >> 8) + e for k, e in zip(keys, ends)])
        sym = self.symbol[np.concatenate([k & 255 for k in keys])].astype(np.int64)
        word = state * self.width + (sym >> 6)
        n = int(ends[-1]) * self.width
        self.bits = np.zeros(n, np.uint64)
        np.bitwise_or.at(self.bits, word, np.uint64(1) << (sym & 63).astype(np.uint64))
        self.base = np.searchsorted(word, np.arange(n)).astype(np.int32)
        targets = [np.frombuffer(r["targets"], np.int32) + np.int32(e) for r, e in zip(rows, ends)]
        self.targets = np.concatenate([*targets, np.zeros(1, np.int32)])
        self.occurs = np.log2(np.concatenate(occurs).astype(np.float32) + 1)
        self.enter = np.tile(self.roots, (len(symbols) + 1, 1))
        first = state == np.repeat(self.roots, [len(k) for k in keys])
        owner = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
        self.enter[sym[first], owner[first]] = self.targets[:-1][first]
        return self

    def parse(self, off: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases, their log2 occurrences summed) of each text and language."""
        n, langs = len(off) - 1, len(self.langs)
        blocks = -(-np.diff(off) // _BLOCK)
        row = np.repeat(np.arange(n), blocks)
        starts = off[row] + (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * _BLOCK
        size = np.minimum(_BLOCK, off[row + 1] - starts)
        order = np.argsort(-size, kind="stable")
        row, starts, size = row[order], starts[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), "left") if len(size) else []
        state = np.tile(self.roots, (len(row), 1))
        count = np.zeros((len(row), langs), np.int32)
        often = np.zeros((len(row), langs), np.float32)
        symbols, one = self.symbol[body], np.uint64(1)
        for t, a in enumerate(active):
            s = symbols[starts[:a] + t]
            now = state[:a]
            at = now if self.width == 1 else now * self.width + (s >> 6)[:, None].astype(np.int32)
            bit = (s & 63).astype(np.uint64)[:, None]
            bits = self.bits[at]
            has = ((bits >> bit) & one).astype(bool)
            place = self.base[at] + np.bitwise_count(bits & ((one << bit) - one))
            fresh = now == self.roots
            often[:a] += np.where(has | fresh, np.float32(0), self.occurs[now])
            count[:a] += fresh | ~has
            state[:a] = np.where(has, self.targets[np.where(has, place, -1)], self.enter[s])
        if len(row):
            often += np.where(state == self.roots, np.float32(0), self.occurs[state])
        out = np.zeros((2, n, langs))
        for k, per_block in enumerate((count, often)):
            for lang in range(langs):
                out[k, :, lang] = np.bincount(row, per_block[:, lang], n)
        return out[0], out[1]


def _predict(shared):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        model = Automata(shared.value) if shared is not None else None
        for batch in batches:
            text = batch.column(1)
            off, body = K.buffers(pc.utf8_lower(text))
            letter = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            best, score, phrases = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
            a = 0
            while model is not None and a < n:
                b = max(a + 1, int(np.searchsorted(off, off[a] + _SLICE, "right")) - 1)
                cut, flat = folded(off[a:b + 1] - off[a], body[off[a]:off[b]])
                count, often = model.parse(cut, flat)
                entropy = count * model.log_size
                order = np.lexsort((np.broadcast_to(np.arange(len(model.langs)), entropy.shape), -often, entropy), axis=1)
                rows = np.arange(b - a)
                best[a:b] = order[:, 0]
                phrases[a:b] = count[rows, order[:, 0]]
                least = entropy[rows, order[:, 0]]
                second = entropy[rows, order[:, 1]] if len(model.langs) > 1 else None
                score[a:b] = second / np.maximum(least + second, 1e-9) if second is not None else 1.0
                a = b
            known = letter if model is not None else np.zeros(n, bool)
            names = np.array(model.langs if model is not None else [""], object)[best]
            names[~known] = UNDETERMINED
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)),
                 pa.array(np.where(known, phrases, 0))], names=["doc_id", "lang_pred", "score", "n_phrases"])
    return run


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", reference_bytes: int = 1 << 17,
          total_bytes: int = 2 << 20) -> Automata | None:
    """Automata of the languages of ``labelled``; None if no row has a language and a text."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and length(text) > 0").withColumn("h", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"),
                                     F.approx_count_distinct("h").alias("texts"), F.min("h").alias("least")).collect()
    if not sizes:
        return None
    limit = max(512, min(reference_bytes, total_bytes // len(sizes)))

    def share(r):
        """Share of the texts by hash, several times what is needed, so that only those are ordered."""
        different = max(1, r["texts"])
        return min(1.0, max(8 * limit * r["n"] / (r["bytes"] * different), 64 / different))

    shares = spark.createDataFrame([(r["lang"], share(r), r["least"]) for r in sizes], "l string, share double, least long")
    drawn = rows.join(F.broadcast(shares), F.col("lang") == F.col("l")).where(     # one row a language
        (F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)) | (F.col("h") == F.col("least"))).drop("l", "share", "least")
    one = drawn.dropDuplicates(["lang", "h"]).withColumn("text", F.substring("text", 1, limit))
    from pyspark.sql import Window
    before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    used = one.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
    built = (used.where(F.col("before") < 2 * limit).select("lang", "text", "h")
             .groupBy("lang").applyInPandas(_build(limit), AUTOMATON).collect())
    return Automata.of(built, {r["lang"]: r["n"] for r in sizes}) if built else None


def identify_language(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", reference_bytes: int = 1 << 17, total_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, lang_pred, score, n_phrases of every row; only rows where ``learnable`` holds teach."""
    model = learn(docs.where(learnable), lang_col, text_col, reference_bytes, total_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model)) if model is not None else None
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(_predict(shared), f"doc_id {kind}, lang_pred string, score double, n_phrases long")
