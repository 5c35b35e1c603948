"""Words of a text column as numpy arrays, hashed without making a string per word.

A word is a maximal run of bytes outside the six ASCII white-space characters
(space and 0x09-0x0D).  Words, word windows and byte n-grams get 64-bit
polynomial hashes from prefix sums: ``sum(T[byte] * P**i)`` modulo 2**64 over a
table T of random 64-bit values, so any span costs one subtraction and one
multiplication.  Texts are handled in chunks of about ``chunk_bytes`` so that the
working arrays stay in the CPU caches; a single longer text is a chunk of its own.
"""

from __future__ import annotations

import ctypes
import inspect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MULT = 0x9E3779B97F4A7C15
MULT_WORDS = 0xD6E8FEB86659FD93
SEED = 20240229


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (for ordering and for partition numbers)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n+1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    large = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, chunk_bytes: int):
    """Consecutive [a, b) document ranges of about ``chunk_bytes``, one document at least."""
    n = len(offsets) - 1
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + chunk_bytes, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def release_memory() -> None:
    """Give memory that is free, but held by the process, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def releasing(work):
    """A task function whose worker gives its free memory back at the end: workers live on, and what one stage has needed
    at its peak would otherwise stay with them through all later ones."""

    def of_batches(batches):
        try:
            yield from work(batches)
        finally:
            release_memory()

    def of_group(group):
        try:
            return work(group)
        finally:
            release_memory()

    return of_batches if inspect.isgeneratorfunction(work) else of_group


class Hasher:
    """Prefix-sum hashing with its power tables, which grow to the longest chunk seen."""

    def __init__(self, lower: bool = False):
        self.table = np.random.default_rng(SEED).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
        if lower:
            self.table[65:91] = self.table[97:123]
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self.nonspace = ~space
        self._pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def powers(self, mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """mult**i and its inverse for i < n."""
        got = self._pow.get(mult)
        if got is None or len(got[0]) < n:
            size = max(n, 1 << 16)
            size += size // 4
            up, down = np.full(size, mult, np.uint64), np.full(size, pow(mult, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            got = self._pow[mult] = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        return got[0][:n], got[1][:n]

    def prefix(self, values: np.ndarray, mult: int) -> np.ndarray:
        """Prefix sums of values[i] * mult**i, with a leading zero."""
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers(mult, len(values))[0], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, mult: int) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self.powers(mult, len(prefix))[1][starts]

    def windows(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of each k consecutive values (across document ends too: the caller masks those)."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        p = self.prefix(words, MULT_WORDS)
        return (p[k:] - p[:-k]) * self.powers(MULT_WORDS, len(p))[1][:n]

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of each word of the documents data[offsets[i]:offsets[i+1]]."""
        n = len(data)
        ns = self.nonspace[data]
        st = np.empty(n, bool)
        st[:1] = ns[:1]
        np.greater(ns[1:], ns[:-1], out=st[1:])
        en = np.empty(n, bool)
        en[-1:] = ns[-1:]
        np.greater(ns[:-1], ns[1:], out=en[:-1])
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        st[heads] = ns[heads]
        tails = heads[1:] - 1 if len(heads) else heads
        en[tails] = ns[tails]
        return np.flatnonzero(st), np.flatnonzero(en) + 1

    def words(self, data: np.ndarray, offsets: np.ndarray) -> "Words":
        starts, ends = self.bounds(data, offsets)
        prefix = self.prefix(self.table[data], MULT)
        hashes = mix(self.spans(prefix, starts, ends, MULT))
        return Words(starts, ends, np.searchsorted(starts, offsets), hashes, prefix)


class Words:
    """starts, ends: byte positions; offsets: first word of each document (n+1);
    hashes: 64 bits a word; prefix: prefix sums of the bytes, for the hashes of other spans."""

    def __init__(self, starts, ends, offsets, hashes, prefix):
        self.starts, self.ends, self.offsets, self.hashes, self.prefix = starts, ends, offsets, hashes, prefix

    def docs(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def doc_sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true marks in [offsets[i], offsets[i+1]) of each document."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(marks.view(np.uint8), offsets[:-1][full], dtype=np.int64)
    return out


def shingle_sets(hasher: Hasher, words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each document.

    A document of fewer than k words has its whole sequence as one shingle; one without words has none.
    """
    h = mix(hasher.windows(words.hashes, k))
    prefix = None
    out = []
    off = words.offsets.tolist()
    for a, b in zip(off[:-1], off[1:], strict=True):
        n = b - a
        if n >= k:
            s = np.sort(h[a : b - k + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif n:
            if prefix is None:
                prefix = hasher.prefix(words.hashes, MULT_WORDS)
            # the length goes in, so that a short sequence never equals a shingle of k words
            w = hasher.spans(prefix, np.array([a]), np.array([b]), MULT_WORDS) + np.uint64(n * 0x5851F42D4C957F2D % 2**64)
            out.append(mix(w))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def word_chunks(hasher: Hasher, col: pa.Array, chunk_bytes: int = 1 << 19):
    """(first document, end document, bytes, byte offsets, Words) of each chunk of a text column."""
    data, offsets = text_buffers(col)
    for a, b in chunks(offsets, chunk_bytes):
        d, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        yield a, b, d, o, hasher.words(d, o)
