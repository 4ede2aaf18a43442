"""NumPy kernels over the raw UTF-8 buffers of Arrow string columns.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  Word hashes
come from one prefix sum over the bytes of a slice of documents, window
hashes from one prefix sum over word hashes, so no Python object is made
per word.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SLICE_BYTES = 2 << 20          # texts are taken in slices of about this size
_BASE = U64(0x9E3779B97F4A7C55)
_WORD_BASE = U64(0xD1B54A32D192ED03)


class _Tables(dict):
    """Power tables of this process; they do not travel with pickled functions."""

    def __reduce__(self):
        return _Tables, ()


_cache = _Tables()


def _pairs(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse mod 2**64, at least n + 1."""
    got = _cache.get(int(base))
    if got is None or len(got[0]) <= n:
        size = max(n + 1, 1 << 20)
        inv = U64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up, down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, b, U64)]))
                        for b in (base, inv))
        got = _cache[int(base)] = (up, down)
    return got


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (every input bit reaches every output bit)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
#: Lower case for ASCII letters, a space for ASCII punctuation, other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
FOLD[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string array; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = col.buffers()
    off = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], body


def slices(col, limit: int = SLICE_BYTES, max_rows: int = 1 << 16):
    """Yield (first row, last row + 1, offsets from 0, bytes) of whole texts."""
    off, body = buffers(col)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, a + max_rows)
        yield a, b, off[a:b + 1] - off[a], body[off[a]:off[b]]
        a = b


def spans(body: np.ndarray, off: np.ndarray, gap: np.ndarray = _GAP):
    """Starts and ends of the runs of non-gap bytes; runs end with their text."""
    solid = ~gap[body]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(body) + 1, bool)
    edge[off] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def byte_sums(body: np.ndarray) -> np.ndarray:
    """Prefix sums from which any span of ``body`` is hashed."""
    up, _ = _pairs(_BASE, len(body))
    sums = np.zeros(len(body) + 1, U64)
    np.cumsum(_BYTE[body] * up[:len(body)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from ``byte_sums``."""
    _, down = _pairs(_BASE, len(sums))
    size = (ends - starts).astype(U64)
    return mix((sums[ends] - sums[starts]) * down[starts] + size * U64(0x2545F4914F6CDD1D))


def words(body: np.ndarray, off: np.ndarray):
    """(hash, row, start, end) of every word of a slice."""
    starts, ends = spans(body, off)
    row = np.searchsorted(off, starts, "right") - 1
    return span_hashes(byte_sums(body), starts, ends), row, starts, ends


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each place (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = _pairs(_WORD_BASE, len(h))
    sums = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n])


def row_hashes(h: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """Hash of each row's whole sequence of values (``first``: first_places)."""
    g = mix(h ^ U64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
    up, down = _pairs(_WORD_BASE, len(g))
    sums = np.zeros(len(g) + 1, U64)
    np.cumsum(g * up[:len(g)], out=sums[1:])
    size = np.diff(first).astype(U64)
    return mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + size)


def run_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the values of each run [start, end)."""
    g = mix(h ^ U64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
    up, down = _pairs(_WORD_BASE, len(g))
    sums = np.zeros(len(g) + 1, U64)
    np.cumsum(g * up[:len(g)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


def inside(row: np.ndarray, k: int) -> np.ndarray:
    """Whether the k values from each place belong to one row."""
    n = len(row) - k + 1
    return row[:n] == row[k - 1:] if n > 0 else np.zeros(0, bool)


def first_places(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Index of each row's first value in a row-ordered array (n_rows + 1)."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def window_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Place of the rightmost minimum of each window of w values.

    Doubling: minima over 1, 2, 4, ... values, then two overlapping halves.
    """
    n = len(v) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, size = np.arange(len(v)), 1
    while size * 2 <= w:
        a, b = best[:-size], best[size:]
        best = np.where(v[b] <= v[a], b, a)
        size *= 2
    a, b = best[:n], best[w - size:w - size + n]
    return np.where(v[b] <= v[a], b, a)
