"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and pairs of words (A-Z lower-cased) are hashed into buckets, as many as there are documents (a power of two within
MIN_BITS and MAX_BITS).  Two bag-of-n-grams models are counted: the target's on labelled good documents, the raw one's on all
documents.  A document's log weight is log p_target - log p_raw, the sum of the log ratios of the two models over
all of its n-grams; with Gumbel noise added, the ``k`` highest keys are a sample without replacement in proportion
to the weights.

The noise is a function of the document id and a seed, so a rerun gives the same sample.  The k-th
key is found by counting keys in finer and finer intervals, so nothing is sorted or collected.
A null text or one without words has weight 0 (log -infinity) and is never chosen; rows that tie at the k-th key are all chosen.
Rows of one id are documents of their own with the same noise.  A text of any length counts whole.  An empty table gives an empty
result; without labelled good documents both models are smoothed alike and the noise and the raw model decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.staging import staged
from lakeops.llm.words import MULT_WORDS, Hasher, mix, releasing, word_chunks

PARTS = 256  # of the buckets, in which tasks send their counts
MIN_BITS, MAX_BITS = 16, 22  # buckets of the models; 2**22 are 32 MB in the driver and in a task


def bucket_bits(n_docs: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, n_docs.bit_length()))


def ngram_buckets(hasher: Hasher, w, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the words and word pairs of a chunk, document of each)."""
    docs = w.docs()
    pairs = hasher.windows(w.hashes, 2)
    inside = docs[: len(pairs)] == docs[1 : len(pairs) + 1]
    h = np.concatenate([mix(w.hashes * np.uint64(MULT_WORDS)), mix(pairs[inside])])
    return (h >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([docs, docs[: len(pairs)][inside]])


class Counts:
    """Raw and target counts of the buckets of a part, without those that are 0, as bytes."""

    @staticmethod
    def pack(raw: np.ndarray, target: np.ndarray) -> bytes:
        at = np.flatnonzero(raw)
        return b"".join([at.astype("<i8").tobytes(), raw[at].astype("<i8").tobytes(), target[at].astype("<i8").tobytes()])

    @staticmethod
    def unpack(blob: bytes) -> np.ndarray:
        """at, raw, target: three rows."""
        return np.frombuffer(blob, "<i8").reshape(3, -1)


def ngram_counts(docs: DataFrame, targets: DataFrame, bits: int, salts: int = 1) -> DataFrame:
    """(part, counts): packed n-gram counts of each of PARTS parts of the buckets, over all documents and over those whose ids are in ``targets``.

    A task sends one row a part; they are added up in ``salts`` groups a part, then by part.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(targets.select("doc_id").distinct().withColumn("good", F.lit(True))), "doc_id", "left")
    size = (1 << bits) // PARTS

    def count(batches):
        hasher = Hasher(lower=True)
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            good = batch.column("good").is_valid().to_numpy(zero_copy_only=False)
            for a, b, _, _, w in word_chunks(hasher, batch.column("text")):
                buckets, owner = ngram_buckets(hasher, w, bits)
                np.add.at(raw, buckets, 1)
                if good[a:b].any():
                    np.add.at(target, buckets[good[a:b][owner]], 1)
        if raw.any():
            parts = [Counts.pack(raw[i * size : (i + 1) * size], target[i * size : (i + 1) * size]) for i in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(parts, pa.binary())], names=["part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros((2, size), np.int64)
        for blob in t.column("counts"):
            got = Counts.unpack(blob.as_py())
            total[:, got[0]] += got[1:]
        return pa.table({"part": t.column("part")[:1], "counts": pa.array([Counts.pack(*total)], pa.binary())})

    by_task = rows.select("text", "good").mapInArrow(releasing(count), "part int, counts binary")
    salted = by_task.groupBy("part", F.pmod(F.xxhash64("counts"), F.lit(salts)).alias("salt")).applyInArrow(releasing(add), "part int, counts binary") if salts > 1 else by_task
    return salted.groupBy("part").applyInArrow(releasing(add), "part int, counts binary")


def log_ratios(counts: DataFrame, bits: int, smoothing: float = 1.0) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw) of every bucket (2**bits numbers at most come to the driver)."""
    raw, target = np.full(1 << bits, smoothing), np.full(1 << bits, smoothing)
    for r in counts.collect():
        got = Counts.unpack(bytes(r["counts"]))
        at = got[0] + r["part"] * ((1 << bits) // PARTS)
        raw[at] += got[1]
        target[at] += got[2]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weights(docs: DataFrame, ratios: np.ndarray, bits: int) -> DataFrame:
    """(doc_id, n_ngrams, log_weight): sum of the log ratios of each whole text (null without words)."""
    part = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches):
        hasher = Hasher(lower=True)
        for batch in batches:
            n, total = [np.zeros(0, np.int64)], [np.zeros(0)]
            for a, b, _, _, w in word_chunks(hasher, batch.column("text")):
                buckets, owner = ngram_buckets(hasher, w, bits)
                n.append(np.bincount(owner, minlength=b - a))
                total.append(np.bincount(owner, sent.value[buckets], b - a))
            n, total = np.concatenate(n), np.concatenate(total)
            weight = pa.array(total, pa.float64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), weight], names=["doc_id", "n_ngrams", "log_weight"])

    return part.mapInArrow(releasing(score), f"doc_id {kind}, n_ngrams long, log_weight double")


def gumbel(doc_id, seed: int):
    """Standard Gumbel noise as a function of the id."""
    u = (F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of a double column, exactly: counts in intervals that narrow to one value."""
    lo, hi, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return lo
    left = k  # rows still to find, from the top, in [lo, hi]
    while lo < hi:
        width = (hi - lo) / bins
        at = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
        inside = rows.filter(F.col(column).between(lo, hi))
        got = {r.b: r for r in inside.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()}
        for b in sorted(got, reverse=True):
            if got[b].c >= left:
                if (lo, hi) == (got[b].lo, got[b].hi) and len(got) == 1:
                    return lo
                lo, hi = got[b].lo, got[b].hi
                break
            left -= got[b].c
    return lo


def resample(docs: DataFrame, labels: DataFrame, *, share: float | None = None, target_docs: int = 20_000, good_value: int = 1, seed: int = 17) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, key, selected) of every document.

    ``target_docs``: most labelled good documents that the target model is fitted on (those of the lowest id hash).
    ``share``: part of the documents to draw; by default that of the good ones among the labelled.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min((F.col("quality") == good_value).cast("int")).alias("good"))
    if share is None:
        share = known.agg(F.avg("good")).first()[0] or 0.0
    targets = known.filter("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_docs)
    n_docs = docs.count()
    bits = bucket_bits(n_docs)
    ratios = log_ratios(ngram_counts(docs, targets, bits, min(256, 1 + n_docs // 10_000_000)), bits)
    keyed = weights(docs, ratios, bits).withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed))
    keyed = staged(keyed, "importance")
    n = keyed.count()
    least = kth_largest(keyed, "key", round(share * n))
    chosen = F.lit(False) if least is None else F.coalesce(F.col("key") >= F.lit(least), F.lit(False))
    return keyed.withColumn("selected", chosen)
