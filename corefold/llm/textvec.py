"""Vectorised tokenising and hashing of whole Arrow string batches with numpy.

All rows of a slice are handled in one pass over their UTF-8 bytes. A word's hash takes its bytes eight at a time, each step through a bijective
mixer; a run of words is hashed as a tree of its words' hashes. Both depend on the order of what they take and not linearly on
it, so no family of strings collides. They pick candidates and shingles; where equality decides, words or collision-resistant digests are compared.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 18
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONG_WORD = 64  # longer words are hashed one by one
SEEDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_BELOW = (np.uint64(1) << (np.arange(9, dtype=np.uint64) % np.uint64(8) * np.uint64(8))) - np.uint64(1)  # masks of that many bytes
_BELOW[8] = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the byte spans [start, end)."""
    n = ends - starts
    out = mix(n.astype(np.uint64) + SEEDS[seed])
    eights = np.ndarray((len(buf) + 1,), "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))
    long = np.flatnonzero(n > LONG_WORD)
    at = np.flatnonzero((n > 0) & (n <= LONG_WORD))
    for done in range(0, LONG_WORD, 8):
        if not len(at):
            break
        left = np.minimum(n[at] - done, 8)
        out[at] = mix(out[at] ^ (eights[starts[at] + done] & _BELOW[left]))
        at = at[left == 8]
        at = at[n[at] > done + 8]
    if len(long):
        data = buf.tobytes()
        out[long] = [xxhash.xxh64_intdigest(data[a:b], int(SEEDS[seed])) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two neighbours each; their order counts."""
    return mix(mix(a + SEEDS[0]) ^ b)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k neighbours: trees over the binary digits of k."""
    out, width, tree, tree_width = None, 0, hashes, 1
    while True:
        if k & tree_width:
            out = tree if out is None else joined(out[: len(hashes) - width - tree_width + 1], tree[width : len(hashes) - tree_width + 1])
            width += tree_width
        if 2 * tree_width > k:
            return out
        tree = joined(tree[: len(tree) - tree_width], tree[tree_width:])
        tree_width *= 2


def folded(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``count`` neighbours from ``first`` on, for short runs of unlike lengths."""
    out = mix(count.astype(np.uint64) + SEEDS[1])
    for k in range(int(count.max()) if len(count) else 0):
        at = np.flatnonzero(count > k)
        out[at] = joined(out[at], hashes[first[at] + k])
    return out


@dataclass
class Words:
    """Words of a slice. ``row`` is each word's row; row r has the words [first[r], first[r + 1])."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        return byte_hash(self.buf, self.starts, self.ends, seed)

    def ids(self) -> np.ndarray:
        """Numbers of the slice's words: equal if and only if the words are. Words of equal hash are compared byte by byte."""
        hashes = self.hashes()
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        a, b = order[:-1][same], order[1:][same]
        n = self.ends - self.starts
        if (n[a] != n[b]).any() or not _equal_bytes(self.buf, self.starts[a], self.starts[b], n[a]):
            known: dict[bytes, int] = {}
            data = self.buf.tobytes()
            return np.array([known.setdefault(data[i:j], len(known)) for i, j in zip(self.starts.tolist(), self.ends.tolist())], np.int64)
        out = np.empty(len(hashes), np.int64)
        out[order] = np.cumsum(np.concatenate(([False], ~same))) if len(order) else 0
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def release() -> None:
    """Hand freed memory back to the system: Arrow's, and what the C library keeps of numpy's arrays."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(texts: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them) for runs of rows of about ``budget`` bytes; a longer row is alone. Nulls count as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + budget, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    del data, offsets, texts
    release()


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in slices of fewer rows, which bounds what is made of them at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        release()


def words(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Words are maximal runs of bytes outside ``space`` within a row."""
    inside = ~space[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets, "left")
    first[-1] = len(starts)
    return Words(buf, offsets, starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def _equal_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
    """Whether the spans of n bytes from a and from b on are equal, all of them."""
    eights = np.ndarray((len(buf) + 1,), "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))
    done = 0
    while len(n) and done < LONG_WORD:
        if (((eights[a + done] ^ eights[b + done]) & _BELOW[np.minimum(n - done, 8)]) != 0).any():
            return False
        done += 8
        left = n > done
        a, b, n = a[left], b[left], n[left]
    data = memoryview(buf)
    return all(data[i : i + k] == data[j : j + k] for i, j, k in zip(a.tolist(), b.tolist(), n.tolist()))


def grams(hashes: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of all k-word windows that stay within a row; ``hashes`` are those of the words."""
    n = len(w.starts)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.row[: n - k + 1] == w.row[k - 1 :])
    return at, runs(hashes, k)[at]


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of a row's bytes the mask has."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
