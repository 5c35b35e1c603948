"""Token ids in directly addressable codes.

A shard holds the ids of consecutive documents.  Each id is cut into chunks of
``chunk_bits`` bits; level 0 has the lowest chunk of every id, level k+1 the next
chunk of those ids that need one.  A bitmap a level says which ids go on, and a rank
directory (ones before each 64-bit word) turns a position of one level into that of
the next.  Any token is read with one look-up a level: no block is decoded.

Layout of a shard, little-endian: magic ``DAC1``; chunk bits, levels (u8 each); six
zero bytes; documents, tokens (u64 each); document ids (i64); which of them are not null (u8 each);
first token of each document and the total (u64); then for each level its length (u64),
chunks (u8 or u16), and, but for the last, padding to 8 bytes, bitmap (u64) and rank directory (u64).

Shards are rows of Parquet files, in ascending order of document id: range ``part`` of the ids,
``seq`` within it.  ``local_start`` counts the tokens of the part before the shard.
Null text counts as empty and has the end id alone.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.spans import SpanCoder, gather, kept_in_worker
from lakeops.llm.words import Hasher, chunks, releasing, text_buffers

MAGIC = b"DAC1"
SHARD_TOKENS = 1 << 18
CHUNK = 1 << 20  # bytes of text coded at a time
FILE_BYTES = 16 << 20  # text of a task that writes, and so of a file


# --- directly addressable codes ---------------------------------------------------
class Level:
    """Chunks of one level and, where ids go on, the bitmap with its rank directory."""

    def __init__(self, chunk: np.ndarray, bitmap: np.ndarray | None = None, ranks: np.ndarray | None = None):
        self.chunk, self.bitmap, self.ranks = chunk, bitmap, ranks

    def goes_on(self, i: np.ndarray) -> np.ndarray:
        return (self.bitmap[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return (self.ranks[i >> 6] + np.bitwise_count(self.bitmap[i >> 6] & below)).astype(np.int64)


def encode_levels(ids: np.ndarray, chunk_bits: int = 8) -> list[Level]:
    kind = np.uint8 if chunk_bits <= 8 else np.uint16
    levels, rest = [], ids.astype(np.uint64)
    while True:
        chunk = (rest & np.uint64((1 << chunk_bits) - 1)).astype(kind)
        rest = rest >> np.uint64(chunk_bits)
        more = rest > 0
        if not more.any():
            levels.append(Level(chunk))
            return levels
        bits = np.zeros(-(-len(more) // 64) * 64, np.uint8)
        bits[: len(more)] = more
        bitmap = np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)
        ones = np.bitwise_count(bitmap).astype(np.uint64)
        levels.append(Level(chunk, bitmap, np.cumsum(ones) - ones))
        rest = rest[more]


def write_shard(doc_ids: list, firsts: np.ndarray, ids: np.ndarray, chunk_bits: int = 8) -> bytes:
    """firsts: first token of each document, and the total."""
    levels = encode_levels(ids, chunk_bits)
    out = [MAGIC, struct.pack("<BB6xQQ", chunk_bits, len(levels), len(doc_ids), len(ids)),
           np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(), firsts.astype("<u8").tobytes()]
    for lv in levels:
        raw = lv.chunk.astype(lv.chunk.dtype.newbyteorder("<")).tobytes()
        out += [struct.pack("<Q", len(lv.chunk)), raw]
        if lv.bitmap is not None:
            out += [b"\0" * (-len(raw) % 8), lv.bitmap.astype("<u8").tobytes(), lv.ranks.astype("<u8").tobytes()]
    return b"".join(out)


class Shard:
    """Random access to the tokens of a shard."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.chunk_bits, n_levels, n_docs, self.n_tokens = struct.unpack_from("<BB6xQQ", blob, 4)
        at = 4 + struct.calcsize("<BB6xQQ")

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        values, valid = read("<i8", n_docs), read("u1", n_docs)
        self.doc_ids = [v if ok else None for v, ok in zip(values.tolist(), valid.tolist(), strict=True)]
        self.firsts = read("<u8", n_docs + 1).astype(np.int64)
        self.levels: list[Level] = []
        for k in range(n_levels):
            (n,) = read("<u8", 1).tolist()
            chunk = read("u1" if self.chunk_bits <= 8 else "<u2", n)
            if k + 1 == n_levels:
                self.levels.append(Level(chunk))
            else:
                at += -chunk.nbytes % 8
                words = -(-n // 64)
                self.levels.append(Level(chunk, read("<u8", words), read("<u8", words)))

    def take(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions of the shard."""
        out = np.zeros(len(positions), np.uint64)
        rows, at = np.arange(len(positions)), np.asarray(positions, np.int64)
        for k, lv in enumerate(self.levels):
            out[rows] |= lv.chunk[at].astype(np.uint64) << np.uint64(k * self.chunk_bits)
            if lv.bitmap is None or not len(rows):
                break
            on = lv.goes_on(at)
            rows, at = rows[on], lv.rank(at[on])
        return out

    def document(self, i: int) -> np.ndarray:
        return self.take(np.arange(self.firsts[i], self.firsts[i + 1]))


# --- text to ids -------------------------------------------------------------------
class WordTokenizer:
    """Ids of whole texts by the tokenizers library, word by word.

    Right for tokenizers that lower-case, drop white space and split letters from what follows them.  A word is cut
    before an ASCII sign that follows a-z, but for ``|``, which ends special tokens.  Each distinct word goes through the library once while the coder holds
    it; words of letters alone go many to a call, as their ids part where a token ends a word.
    """

    JOINED = 200  # words of letters in one call

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.coder = SpanCoder(self._learn, lower=True, exact=b"<|")  # special tokens are matched in their own case
        self.words = Hasher()
        self.letter, self.point = np.zeros(256, bool), np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.point[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "|"]] = True

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, ends = data.tobytes(), np.cumsum(n_bytes).tolist()
        texts = [raw[a:b].decode("utf-8") for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        letters = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        alpha, other = np.flatnonzero(letters).tolist(), np.flatnonzero(~letters).tolist()
        parts, sizes, owners = [], [], []
        groups = [alpha[a : a + self.JOINED] for a in range(0, len(alpha), self.JOINED)]
        for group, ids in zip(groups, self._each(["\n".join(texts[i] for i in g) for g in groups]), strict=True):
            ids = np.array(ids, np.int32)
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(group):
                parts.append(ids)
                sizes.append(np.diff(cuts, prepend=0))
                owners.append(group)
            else:  # a letter whose lower case is more than letters
                other += group
        each = self._each([texts[i] for i in other])
        parts.append(np.array([x for ids in each for x in ids], np.int32))
        sizes.append(np.array([len(ids) for ids in each], np.int64))
        owners.append(other)
        flat, size, owner = np.concatenate(parts), np.concatenate(sizes).astype(np.int64), np.concatenate([np.array(o, np.int64) for o in owners])
        order = np.argsort(owner)
        return gather(flat, (np.cumsum(size) - size)[order], size[order]), size[order]

    def _coded(self, col: pa.Array, flat: bool):
        data, offsets = text_buffers(col)
        for a, b in chunks(offsets, CHUNK):
            d, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends = self.words.bounds(d, o)
            cut = np.zeros(len(d), bool)
            cut[1:] = self.point[d[1:]] & self.letter[d[:-1]]
            cut[starts] = False
            cut = np.flatnonzero(cut)
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
            ids, sizes = self.coder.code(d, starts, ends, flat)
            yield ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, o)]

    def encode(self, col: pa.Array):
        """(flat ids, first id of each text and the total) for each chunk of the column, in order."""
        return self._coded(col, True)

    def counts(self, col: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return np.concatenate([np.zeros(0, np.int64), *(np.diff(firsts) for _, firsts in self._coded(col, False))])


def with_end(flat: np.ndarray, firsts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each document."""
    n = len(firsts) - 1
    sizes = np.diff(firsts)
    out = np.full(len(flat) + n, end_id, np.int64)
    out[np.arange(len(flat)) + np.repeat(np.arange(n), sizes)] = flat
    return out, firsts + np.arange(n + 1)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, end_id: int, chunk_bits: int = 8, shard_tokens: int = SHARD_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the shards under ``path`` in ascending document id.

    Texts are dealt by ranges of the id and sorted within; rows of one id are ordered by a hash of their text.
    A shard ends after the document that fills it, and with its range.  A task writes ranges of some FILE_BYTES of text one after
    the other, so files are as many as the texts ask for, and not as the shuffle has partitions: an executor that makes a file forks.
    Spark's committer makes each file appear once and whole.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = part.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # numbered before they are put together: a task's ranges need not be neighbours
    ordered = part.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    ordered = ordered.coalesce(max(1, -(-total // FILE_BYTES)))

    def of_one_range(batches):
        for batch in batches:
            part = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)

    def shards(batches):
        tok = kept_in_worker(f"tokens {name}", lambda: WordTokenizer(SparkFiles.get(name)))
        number, seq, start = None, 0, 0
        ids, flats, sizes, held = [], [], [], 0

        def flush():
            nonlocal seq, start, ids, flats, sizes, held
            flat, firsts = np.concatenate(flats), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            row = [number, seq, start, len(flat), len(ids), write_shard(ids, firsts, flat, chunk_bits)]
            seq, start, ids, flats, sizes, held = seq + 1, start + len(flat), [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v]) if i < 5 else pa.array([v], pa.binary()) for i, v in enumerate(row)],
                                              names=["part", "seq", "local_start", "n_tokens", "n_docs", "shard"])

        for batch in of_one_range(batches):
            if batch.column("part")[0].as_py() != number:
                if ids:
                    yield flush()
                number, seq, start = batch.column("part")[0].as_py(), 0, 0
            all_ids, at = batch.column("doc_id").to_pylist(), 0
            for flat, firsts in tok.encode(batch.column("text")):
                flat, firsts = with_end(flat, firsts, end_id)
                a, n = 0, len(firsts) - 1
                while a < n:
                    # up to the document that fills the shard
                    b = min(n, int(np.searchsorted(firsts, firsts[a] + shard_tokens - held, "left")))
                    b = max(b, a + 1)
                    ids += all_ids[at + a : at + b]
                    flats.append(flat[firsts[a] : firsts[b]])
                    sizes.append(np.diff(firsts[a : b + 1]))
                    held += int(firsts[b] - firsts[a])
                    a = b
                    if held >= shard_tokens:
                        yield flush()
                at += n
        if ids:
            yield flush()

    schema = "part long, seq long, local_start long, n_tokens long, n_docs long, shard binary"
    ordered.mapInArrow(releasing(shards), schema).write.mode("error").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of tokens before each one.

    Only the totals of the parts (one row a part) are summed in order and sent to all tasks.
    """
    shards = spark.read.parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return shards.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("local_start"))


def document_report(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, read back from the files."""

    def report(batches):
        for batch in batches:
            for start, blob in zip(batch.column("start").to_pylist(), batch.column("shard"), strict=True):
                shard = Shard(blob.as_py())
                crc = [zlib.crc32(shard.document(i).astype("<u4").tobytes()) for i in range(len(shard.doc_ids))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(start + shard.firsts[:-1]), pa.array(np.diff(shard.firsts)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_tokens(spark, path).select("start", "shard").mapInArrow(releasing(report), "doc_id long, start long, n_tokens long, ids_crc32 long")
