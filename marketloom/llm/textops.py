"""Word and byte hashes of whole Arrow text columns in numpy, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.default_rng(20240607)
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
ODD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U(2) + U(1)
#: 0x20 and 0x09 to 0x0D part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Lower case, and white space for ASCII marks: words are runs of ASCII letters and digits and of other letters' bytes.
PLAIN = LOWER.copy()
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
#: Bytes of text whose arrays are held at once, and of few texts, such as the driver's benchmark items.
PIECE, SHORT = 2 << 20, 1 << 16

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + 4096 if n > SHORT else SHORT)
        for name, b in (("up", BASE), ("down", INVERSE)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of TABLE[data[k]] * BASE**k over i <= k < j."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(TABLE[data] * up[: len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; the length takes part."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * ODD[0])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def groups(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; no word crosses rows."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0] = after[-1] = False
        before[1:] = word[:-1]
        after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of short runs of rows; a row longer than PIECE comes in several, cut at white space."""
    for i, j in groups(offsets):
        own = data[offsets[i] : offsets[j]]
        if len(own) <= 2 * PIECE:
            yield i, own, offsets[i : j + 1] - offsets[i]
            continue
        s = 0
        while s < len(own):
            e = min(s + PIECE, len(own))
            while e < len(own) and not SPACE[own[e]]:
                more = np.flatnonzero(SPACE[own[e : e + 4096]])
                e = e + int(more[0]) if len(more) else min(e + 4096, len(own))
            yield i, own[s:e], np.array([0, e - s])
            s = e


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(data, offsets)
    hashes = span_hash(prefix_hash(data), starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of rows (i, j): hashes of the words, and where each row's begin (j - i + 1 numbers).

    data should be lower-cased already where that is wanted. A row longer than PIECE is hashed piece by piece, cut at
    white space, so that memory stays in proportion to the text.
    """
    for i, j in groups(offsets):
        parts = [_words(own, at) for _, own, at in pieces(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
        if len(parts) == 1:
            yield i, j, *parts[0]
        elif parts:
            hashes = np.concatenate([p[0] for p in parts])
            yield i, j, hashes, np.array([0, len(hashes)])


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles of one text, with repeats; the whole sequence is one if it has fewer words."""
    if len(hashes) == 0:
        return hashes
    if len(hashes) < n:
        out = (hashes * ODD[1 : 1 + len(hashes)]).sum(dtype=np.uint64, keepdims=True) + ODD[39 - len(hashes)]
        return mix(out)
    out = hashes[: len(hashes) - n + 1] * ODD[1]
    for k in range(1, n):
        out = out + hashes[k : len(hashes) - n + 1 + k] * ODD[1 + k]
    return mix(out + ODD[39 - n])
