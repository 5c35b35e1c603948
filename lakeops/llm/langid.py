"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its subwords: runs of 2 to 4 bytes within
a word, its edges marked, hashed into a fixed number of buckets.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a bounded
sample of labelled documents.  As averaging and softmax are linear up to the end,
the model is applied as one table of logits per bucket.

Scores are calibrated on a part of the sample that was kept out of training: a
temperature is fitted, and the rejection threshold is the lowest score from which on
the accepted documents of that part are right as often as asked (at least
``min_score``, below which a prediction is more likely wrong than right).

A null text, or one without letters, is ``und`` with score 0 and is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.words import Hasher, chunks, mix, release_memory, releasing, text_buffers

SIZES = (2, 3, 4)
BUCKET_BITS = 16
UNKNOWN = "und"
CHUNK = 1 << 19
MULT_GRAM = 0xA0761D6478BD642F


class Subwords:
    """Buckets of the subwords of each text."""

    def __init__(self):
        self.hasher = Hasher(lower=True)
        self.letter = np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
        # anything but letters is one and the same edge mark
        self.value = np.where(self.letter, self.hasher.table, np.uint64(0x632BE59BD9B4E019))

    def padded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A space before each text and one at the end, so that no subword spans two texts."""
        n = len(offsets) - 1
        out = np.full(len(data) + n + 1, 32, np.uint8)
        out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
        return out, offsets + np.arange(n + 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(buckets, first of each text and the total) for each subword size."""
        d, o = self.padded(data, offsets)
        is_letter, prefix = self.letter[d], self.hasher.prefix(self.value[d], MULT_GRAM)
        down = self.hasher.powers(MULT_GRAM, len(prefix))[1]
        for size in SIZES:
            n = len(d) - size + 1
            if n <= 0:
                yield np.zeros(0, np.int64), np.zeros(len(o), np.int64)
                continue
            if size == 2:
                ok = is_letter[:-1] | is_letter[1:]
            else:
                ok = is_letter[1 : n + 1].copy()
                for j in range(2, size - 1):
                    ok &= is_letter[j : n + j]
            at = np.flatnonzero(ok)
            h = mix((prefix[at + size] - prefix[at]) * down[at] + np.uint64(size))
            yield (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(at, o)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # logits of each bucket: the text's logits are their average
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.5

    def logits(self, sub: Subwords, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        count = np.zeros(len(offsets) - 1)
        for buckets, first in sub(data, offsets):
            full = first[1:] > first[:-1]
            if full.any():
                total[full] += np.add.reduceat(self.table[buckets], first[:-1][full], axis=0)
                count += np.diff(first)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def scores(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], *, dim: int = 16, epochs: int = 4, rate: float = 0.5, gain: float = 10.0,
          calibrate: float = 0.25, min_score: float = 0.5, max_error: float = 0.02, seed: int = 11) -> Model:
    """bags: (distinct buckets, their counts) of each document, in types as small as they come."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(x) for x in labels])
    apart = rng.random(len(bags)) < calibrate
    fit = np.flatnonzero(~apart) if (~apart).any() else np.arange(len(bags))
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << BUCKET_BITS, dim)).astype(np.float32)
    soft, bias = np.zeros((len(langs), dim), np.float32), np.zeros(len(langs), np.float32)

    def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
        buckets, counts = bags[i]
        return buckets.astype(np.int64), (counts / counts.sum()).astype(np.float32)

    step, steps = 0, max(1, epochs * len(fit))
    for _ in range(epochs):
        for i in rng.permutation(fit):
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            idx, w = bag(i)
            rows = emb[idx]
            v = w @ rows
            z = soft @ v + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = p @ soft
            soft -= lr * np.outer(p, v)
            bias -= np.float32(0.01) * lr * p
            # an averaged embedding gets its share of the gradient; scaled up as shares are small
            emb[idx] = rows - lr * np.float32(gain) * np.outer(w, back)
    model = Model(langs, emb @ soft.T, bias.astype(float))
    held = np.flatnonzero(apart) if apart.sum() >= 20 else fit
    logits = np.array([w @ model.table[idx] + model.bias for idx, w in map(bag, held)])
    return calibrated(model, logits, y[held], min_score, max_error)


def calibrated(model: Model, logits: np.ndarray, y: np.ndarray, min_score: float, max_error: float) -> Model:
    """Temperature of the lowest log loss, and the rejection threshold."""
    best = np.inf
    # one more document, wrongly told, counts as seen: without it a sample without errors would make every score 1
    doubt = 1 / (len(y) + 2)
    for t in np.geomspace(0.05, 1000, 121):
        p = np.maximum(Model(model.langs, model.table, model.bias, t).scores(logits), 1e-12)
        right = p[np.arange(len(y)), y]
        others = (np.log(p).sum(axis=1) - np.log(right)) / max(1, p.shape[1] - 1)
        loss = -((1 - doubt) * np.log(right) + doubt * others).mean()
        if loss < best:
            best, model.temperature = loss, float(t)
    p = model.scores(logits)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    error = np.cumsum(~right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(error <= max_error)
    model.reject_below = max(min_score, float(top[order][good[-1]]) if len(good) and good[-1] + 1 < len(y) else 0.0)
    return model


def fit(docs: DataFrame, *, sample_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Model | None:
    """Train on at most ``sample_docs`` documents of ``docs`` with a language and a text: those of the lowest id hash.

    Only the bucket counts of these documents come to the driver.  None if there is none.
    """
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = part.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = labelled.select("doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample_docs)
    sample = labelled.join(F.broadcast(ids.distinct()), "doc_id", "left_semi")

    def bags(batches):
        sub = Subwords()
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                d = data[offsets[i] : offsets[i + 1]]
                found = np.concatenate([b for b, _ in sub(d, np.array([0, len(d)]))])
                if len(found) and has_letter(d.tobytes().decode("utf-8")):
                    buckets, counts = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, 1), pa.array([lang], pa.string()), pa.array([buckets.astype(np.uint16).tobytes()], pa.binary()),
                         pa.array([counts.astype(np.uint32).tobytes()], pa.binary())], names=["doc_id", "lang", "buckets", "counts"])

    kind = part.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(releasing(bags), f"doc_id {kind}, lang string, buckets binary, counts binary").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "lang", "buckets").limit(2 * sample_docs).collect()
    if not rows:
        return None
    model = train([(np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.counts, np.uint32)) for r in rows], [r.lang for r in rows], **options)
    del rows
    release_memory()
    return model


class Predictor:
    """Language, score and rejection of the texts of a column."""

    def __init__(self, model: Model | None):
        self.model, self.sub = model, Subwords()
        self.ascii_letter = np.zeros(256, bool)
        self.ascii_letter[[*range(65, 91), *range(97, 123)]] = True

    def __call__(self, col: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        model = self.model
        data, offsets = text_buffers(col)
        lang, score, rejected = [], [], []
        for a, b in chunks(offsets, CHUNK):
            d, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            seen = np.concatenate([[0], np.cumsum(self.ascii_letter[d])])[o]
            sure = seen[1:] > seen[:-1]
            p = model.scores(model.logits(self.sub, d, o)) if model else np.zeros((b - a, 1))
            best, top = p.argmax(axis=1).tolist(), p.max(axis=1).tolist()
            for i in range(b - a):
                ok = model is not None and (sure[i] or has_letter(d[o[i] : o[i + 1]].tobytes().decode("utf-8")))
                lang.append(model.langs[best[i]] if ok else UNKNOWN)
                score.append(top[i] if ok else 0.0)
                rejected.append(not ok or top[i] < model.reject_below)
        return lang, score, rejected


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each row, from its whole text alone."""
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()

    def run(batches):
        predictor = Predictor(model)
        for batch in batches:
            lang, score, rejected = predictor(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                                             names=["doc_id", "lang_pred", "score", "rejected"])

    return part.mapInArrow(releasing(run), f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all of their columns, that the model does not reject."""

    def run(batches):
        predictor = Predictor(model)
        for batch in batches:
            rejected = predictor(batch.column(text_col))[2]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)


def held_out(doc_id):
    """Documents that training never sees: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(doc_id.cast("string")) % 3 == 1
