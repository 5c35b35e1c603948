"""Whole-text statistics of a document (counts of words, lines, symbols, repeats) for quality rules."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.words import Hasher, Words, doc_sums, mix, releasing, word_chunks

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct", "n_stutter")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _marks(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def line_counts(h: Hasher, d: np.ndarray, o: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word, and those of them that equal an earlier line."""
    breaks = np.flatnonzero(d == 10)
    starts = np.sort(np.concatenate([o[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, o[1:]]))
    # a break that ends a document and the next document's start share a position; both orders give the same pairs
    docs = np.repeat(np.arange(len(o) - 1), np.diff(np.searchsorted(breaks, o)) + 1)
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, docs = starts[worded], ends[worded], docs[worded]
    n = len(o) - 1
    lines = np.bincount(docs, minlength=n)
    spans = h.spans(w.prefix, starts, ends, 0x9E3779B97F4A7C15) + (ends - starts).astype(np.uint64) * _ODD
    _, first = np.unique(mix(mix(spans) + docs.astype(np.uint64) * _ODD), return_index=True)
    return lines, lines - np.bincount(docs[first], minlength=n)


def repeat_words(h: Hasher, w: Words) -> np.ndarray:
    """Per document: words covered by a 5-word window that occurs at least twice in the document."""
    off, nw = w.offsets, len(w.hashes)
    out = np.zeros(len(off) - 1, np.int64)
    win = h.windows(w.hashes, WINDOW)
    if not len(win):
        return out
    docs = w.docs()
    inside = docs[: len(win)] == docs[WINDOW - 1 :]
    keys = mix(win + docs[: len(win)].astype(np.uint64) * _ODD)
    s = np.sort(keys[inside])
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return out
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hit = (twice[at] == keys) & inside
    cover = np.zeros(nw, bool)
    for i in range(WINDOW):
        cover[i : i + len(hit)] |= hit
    return doc_sums(cover, off)


def stutter_words(w: Words) -> np.ndarray:
    """Per document: words equal to the word before them."""
    same = np.zeros(len(w.hashes), bool)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    same[w.offsets[:-1][w.offsets[:-1] < w.offsets[1:]]] = False
    return doc_sums(same, w.offsets)


def _stats(batches):
    h = Hasher()
    symbol, upper, digit = _marks(SYMBOLS), _marks(bytes(range(65, 91))), _marks(b"0123456789")
    punct = _marks(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
    inner = (np.arange(256) & 0xC0) != 0x80
    for batch in batches:
        got = [np.zeros((0, len(COLUMNS)), np.int64)]
        for _, _, d, o, w in word_chunks(h, batch.column("text")):
            lines, dups = line_counts(h, d, o, w)
            chars = doc_sums(h.nonspace[d] & inner[d], o)
            got.append(np.stack([np.diff(w.offsets), chars, doc_sums(symbol[d], o), dups, repeat_words(h, w), lines,
                                 doc_sums(upper[d], o), doc_sums(digit[d], o), doc_sums(punct[d], o), stutter_words(w)], axis=1))
        out = np.concatenate(got)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(np.ascontiguousarray(out[:, i])) for i in range(len(COLUMNS)))],
            names=["doc_id", *COLUMNS])


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id (as ``doc_id``) and COLUMNS (longs), over the whole text.

    Null and empty texts have zeros.  Other columns of ``docs`` are not read.
    """
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()
    return part.mapInArrow(releasing(_stats), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS))
