"""Document fingerprints: bottom-k sketches of word-shingle hashes.

The sketch of a set of shingles is its ``k`` smallest 48-bit hashes.  The sketch
of a union is the ``k`` smallest of the parts' sketches, so sketches merge across
parts of a document, a source or a corpus.  From two sketches come estimates of
resemblance (Jaccard), containment and the number of distinct shingles; below
``k`` shingles the sketch is the whole set and the numbers are exact.

Shingles are five consecutive words, A-Z lower-cased; a shorter text is one shingle,
a text without words has the empty sketch (an empty string).  Two empty sketches
resemble each other fully, an empty and a full one not at all.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.staging import staged
from lakeops.llm.words import Hasher, releasing, shingle_sets, word_chunks
from lakeops.operators.projection import add_seq_key

K = 128
SHINGLE = 5
BITS = 48
MAX_BLOCKS = 1 << 16
SLICE = 512  # rows whose texts and edited texts are held as Python strings at a time


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Bottom-k of sorted distinct 64-bit hashes."""
    top = hashes[: k + 64] >> np.uint64(64 - BITS)
    top = np.unique(top)
    # only ties of the shortened hashes can leave too few of the slice
    return (top if len(top) >= k or len(hashes) <= k + 64 else np.unique(hashes >> np.uint64(64 - BITS)))[:k]


def to_text(s: np.ndarray) -> str:
    raw = s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :]
    return base64.b64encode(np.ascontiguousarray(raw).tobytes()).decode("ascii")


def from_text(t: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(t or ""), np.uint8).reshape(-1, BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 8 - BITS // 8 :] = raw
    return out.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union."""
    return np.union1d(a, b)[:k]


def n_distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[k - 1]) + 1) / 2.0**BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness of the two shingle sets."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has (1 for an empty a)."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * n_distinct(merge(a, b, k), k) / n_distinct(a, k))


def sketches(hasher: Hasher, col: pa.Array, k: int = K) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, _, _, w in word_chunks(hasher, col):
        out += [sketch(s, k) for s in shingle_sets(hasher, w, SHINGLE)]
    return out


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_shingles_est) of each row."""
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()

    def make(batches):
        hasher = Hasher(lower=True)
        for batch in batches:
            got = sketches(hasher, batch.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([to_text(s) for s in got], pa.string()), pa.array([n_distinct(s, k) for s in got], pa.float64())],
                names=["doc_id", "fingerprint", "n_shingles_est"])

    return part.mapInArrow(releasing(make), f"doc_id {kind}, fingerprint string, n_shingles_est double")


def merge_by(prints: DataFrame, key: str, k: int = K) -> DataFrame:
    """Merged sketch per key: (key, fingerprint, n_shingles_est).

    Each task first merges its own rows of a key, so a key that holds most rows sends one sketch per task.
    """
    part = prints.select(F.col(key).alias("key"), F.col("fingerprint").alias("fingerprint"))
    kind = part.schema["key"].dataType.simpleString()

    def combine(tables):
        have: dict = {}
        for t in tables:
            for name, text in zip(t.column("key").to_pylist(), t.column("fingerprint").to_pylist(), strict=True):
                s = from_text(text)
                have[name] = merge(have[name], s, k) if name in have else s
        return have

    def rows(have: dict, key_type: pa.DataType):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(have), key_type), pa.array([to_text(s) for s in have.values()], pa.string()), pa.array([n_distinct(s, k) for s in have.values()], pa.float64())],
            names=["key", "fingerprint", "n_shingles_est"])

    def local(batches):
        first = None
        have: dict = {}
        for b in batches:
            first = first or b.schema.field("key").type
            for name, s in combine([b]).items():
                have[name] = merge(have[name], s, k) if name in have else s
            if len(have) > 20_000:
                yield rows(have, first)
                have = {}
        if have:
            yield rows(have, first)

    def final(t: pa.Table) -> pa.Table:
        return pa.Table.from_batches([rows(combine([t]), t.schema.field("key").type)])

    schema = f"key {kind}, fingerprint string, n_shingles_est double"
    out = part.mapInArrow(releasing(local), schema).groupBy("key").applyInArrow(releasing(final), schema)
    return out.withColumnRenamed("key", key)


class Blocks:
    """First rows (doc_id, h) of consecutive blocks in the order of doc_id, nulls first, then h."""

    def __init__(self, rows: list[tuple[int | None, int]]):
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        self.n = len(rows)
        self.no_id = np.array([h for i, h in rows if i is None], np.int64)
        self.ids = np.array([i for i, _ in rows if i is not None], np.int64)
        self.h = np.array([h for i, h in rows if i is not None], np.int64)

    def of(self, ids: np.ndarray, known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, whether it is the block's first row) of each row; ``known``: it has an id."""
        block = np.searchsorted(self.no_id, h, "right") - 1
        lo, hi = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        at = lo - 1
        for i in np.flatnonzero(known & (hi > lo)).tolist():  # an id at which blocks begin
            at[i] = lo[i] - 1 + np.searchsorted(self.h[lo[i] : hi[i]], h[i], "right")
        block = np.where(known, at + len(self.no_id), block)
        ids_at, h_at = np.concatenate([np.zeros(len(self.no_id), np.int64), self.ids]), np.concatenate([self.no_id, self.h])
        is_known = np.arange(self.n) >= len(self.no_id)
        return block, (h_at[block] == h) & (is_known[block] == known) & (~known | (ids_at[block] == ids))


def with_successors(docs: DataFrame, rows_per_block: int = 8192) -> DataFrame:
    """(block, ghost, doc_id, h, text), where each row's successor by ascending doc_id is the next row of its block.

    Ids, with a hash of the text, are numbered in their order; every ``rows_per_block``-th begins a block, so ids may lie as wide
    apart or as close as they like.  There are MAX_BLOCKS blocks at most (their first ids and hashes, 1 MB, are sent to the tasks); beyond
    that they get longer, and are read as a stream all the same.  The first document of each block is also sent, as
    ``ghost``, to the block before it (that of the first block to the last), so texts are shuffled once and no
    block needs another.  Sort by (block, ghost, doc_id, h) to read it.  Null ids come first; rows of one
    id are ordered by a hash of their text.
    """
    part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    keys = staged(part.select("doc_id", "h"), "successor-keys")
    per_block = max(rows_per_block, -(-keys.count() // MAX_BLOCKS))
    first = add_seq_key(keys, "nth", ["doc_id", "h"]).filter((F.col("nth") - 1) % per_block == 0).select("doc_id", "h").distinct()
    blocks = Blocks([(r.doc_id, r.h) for r in first.collect()])

    def deal(batches):
        for batch in batches:
            ids, h = batch.column("doc_id"), batch.column("h").to_numpy()
            block, is_first = blocks.of(pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), h)
            for rows, to, ghost in ((np.arange(len(h)), block, 0), (np.flatnonzero(is_first), (block - 1) % max(blocks.n, 1), 1)):
                if len(rows):
                    out = batch if len(rows) == len(h) else batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(to[rows], pa.int64()), pa.array(np.full(len(rows), ghost, np.int32)), *(out.column(c) for c in ("doc_id", "h", "text"))],
                                                     names=["block", "ghost", "doc_id", "h", "text"])

    dealt = part.mapInArrow(releasing(deal), "block long, ghost int, doc_id long, h long, text string")
    return dealt.repartition("block").sortWithinPartitions("block", "ghost", "doc_id", "h")


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_report(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness (see ``edited_text``).

    The successor of the last document is the first (a single document's is itself).  Null texts count as empty, null ids come
    first, ids may be any long; rows of one id follow each other.  A text of any length is read whole.  An empty table gives an empty result.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles_est", "contained_in_next"]
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, n_shingles_est double, contained_in_next double")

    def report(batches):
        hasher = Hasher(lower=True)
        last = None  # the row before the slice: block, ghost, doc_id, text, sketch
        for batch in batches:
            for a in range(0, len(batch), SLICE):
                part = batch.slice(a, SLICE)
                col = part.column("text")
                rows = list(zip(part.column("block").to_pylist(), part.column("ghost").to_pylist(), part.column("doc_id").to_pylist(),
                                col.to_pylist(), sketches(hasher, col, k), strict=True))
                if last is not None:
                    rows.insert(0, last)
                last = rows[-1]
                pairs = [(x, y) for x, y in zip(rows[:-1], rows[1:], strict=True) if x[0] == y[0] and not x[1]]
                edits = pa.array([edited_text(x[3], y[3]) for x, y in pairs], pa.string())
                prints = sketches(hasher, edits, k)
                out = [[] for _ in names]
                for (x, y), e, p in zip(pairs, edits.to_pylist(), prints, strict=True):
                    row = (x[2], len(x[3]), hashlib.sha256(e.encode()).hexdigest(), to_text(x[4]), to_text(p),
                           resemblance(x[4], p, k), resemblance(x[4], y[4], k), n_distinct(x[4], k), containment(x[4], y[4], k))
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return with_successors(docs).mapInArrow(releasing(report), schema)
