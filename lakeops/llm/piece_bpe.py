"""Encoding and decoding for merge-type (BPE) SentencePiece vocabularies.

The text is cut where a space follows a non-space: no piece of such a vocabulary
goes on across that point (checked when the model is loaded), so each segment can
be merged alone and distinct segments are merged once per batch.  Within a
segment an agenda holds its adjacent symbol pairs ordered by score, then by
position; the top pair is merged, its new neighbours enter the agenda, stale pairs
are passed over.  Symbols that are no piece become byte pieces.

Short segments share array agendas: the scores of all pairs of many segments
stand in one array, and each round merges every segment's top pair.  Long ones
use a heap each.

Every distinct segment is checked against the sentencepiece library in the Arrow
batch that brings it (column ``agrees``: all segments of the text); decoding is the library's.  Null text counts as empty and has no ids.
"""

from __future__ import annotations

import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.spans import SpanCoder, gather, kept_in_worker
from lakeops.llm.words import chunks, releasing, text_buffers

SPACE = "▁"
SHORT = 40  # symbols; longer segments use a heap
GROUP = 4_000  # segments merged together
CHUNK = 1 << 21  # bytes of text coded at a time
AGREES, DIFFERS = -1, -2
NORMAL, UNKNOWN, BYTE = 1, 2, 6


class PieceModel:
    """Pieces, scores and the table of pairs that merge, read from a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            data = f.read()
        proto.ParseFromString(data)
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte pieces is needed")
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("a model that keeps its text as it is, with a leading space, is needed")
        if any(p.type not in (NORMAL, UNKNOWN, BYTE, 3) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece goes on after an inner space")
        self.library = SentencePieceProcessor(model_proto=data)
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.n_pieces = len(proto.pieces)
        # symbols: ids of pieces; then characters that occur in pieces but are no piece; then any other character
        symbol = {p: i for p, (i, _) in pieces.items()}
        self.inner_chars: dict[int, int] = {}
        for c in sorted({c for p in pieces for c in p} - set(pieces)):
            symbol[c] = self.n_pieces + len(self.inner_chars)
            self.inner_chars[symbol[c]] = ord(c)
        self.top = self.n_pieces + len(self.inner_chars)
        self.symbol_of = np.arange(self.top, self.top + 0x110000, dtype=np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.symbol_of[32] = self.symbol_of[ord(SPACE)]
        merged: dict[tuple[int, int], tuple[int, float]] = {}
        for p, (i, score) in pieces.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    merged[a, b] = (i, score)
        self.merged = merged
        keys = np.array([(a << 32) | b for a, b in merged], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.to = np.append(np.array([m[0] for m in merged.values()], np.int32)[order], 0)
        # the order of the scores is all that counts: 1 is the lowest, equal scores have equal ranks
        _, rank = np.unique(np.array([m[1] for m in merged.values()]), return_inverse=True)
        self.rank = np.append(rank[order].astype(np.int32) + 1, 0)

    # --- one segment, with a heap -------------------------------------------------
    def merge_heap(self, symbols: list[int]) -> list[int]:
        """The final symbols of one segment."""
        symbols: list = list(symbols)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list = []

        def enter(i: int) -> None:
            j = after[i]
            if j >= 0 and (m := self.merged.get((symbols[i], symbols[j]))):
                heapq.heappush(agenda, (-m[1], i, j, symbols[i], symbols[j], m[0]))

        for i in range(n - 1):
            enter(i)
        while agenda:
            _, i, j, a, b, to = heapq.heappop(agenda)
            if symbols[i] != a or after[i] != j or symbols[j] != b:
                continue  # stale: one side has been merged since
            symbols[i], symbols[j] = to, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                enter(before[i])
            enter(i)
        return [s for s in symbols if s is not None]

    # --- many short segments at once ----------------------------------------------
    def merge_many(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(final symbols of all segments in order, number of each segment's).

        The agendas stand in flat arrays: each round merges the top pair of every segment.
        """
        owner = np.arange(len(size))
        done_owner, done_sym = [], []
        rank, to = self._pairs(sym, np.append(sym[1:], np.int32(0)))
        rank[np.cumsum(size) - 1] = 0  # the last symbol of a segment has no pair
        while len(size):
            starts = np.cumsum(size) - size
            best = np.maximum.reduceat(rank, starts)
            over = best == 0
            if over.any():
                rows = np.repeat(over, size)
                done_owner.append(np.repeat(owner[over], size[over]))
                done_sym.append(sym[rows])
                rows = ~rows
                sym, rank, to, owner, size, best = sym[rows], rank[rows], to[rows], owner[~over], size[~over], best[~over]
                if not len(size):
                    break
                starts = np.cumsum(size) - size
            tops = np.flatnonzero(rank == np.repeat(best, size))
            at = tops[np.searchsorted(tops, starts)]  # the leftmost of equal scores
            sym[at] = to[at]
            last = at + 2 == starts + size  # nothing follows the pair
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, rank, to, size = sym[keep], rank[keep], to[keep], size - 1
            at = at - np.arange(len(at))
            starts = np.cumsum(size) - size
            rank[at] = 0
            i = np.concatenate([at[at > starts] - 1, at[~last]])
            rank[i], to[i] = self._pairs(sym[i], sym[i + 1])
        who = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        order = np.argsort(who, kind="stable")
        n = int(owner[-1]) + 1 if len(owner) else (int(who.max()) + 1 if len(who) else 0)
        return (np.concatenate(done_sym)[order] if done_sym else sym[:0]), np.bincount(who, minlength=n)

    def spell(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols to ids: a character that is no piece becomes the pieces of its UTF-8 bytes."""
        odd = np.flatnonzero(sym >= self.n_pieces)
        if not len(odd):
            return sym, size
        raw = [chr(c).encode("utf-8") for c in self.char_of(sym[odd]).tolist()]
        n = np.ones(len(sym), np.int64)
        n[odd] = [len(r) for r in raw]
        out = np.repeat(sym, n)
        is_byte = np.repeat(sym >= self.n_pieces, n)
        out[is_byte] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(size)]
        return out, np.diff(ends, prepend=0)

    def char_of(self, sym: np.ndarray) -> np.ndarray:
        """Code points of symbols that are no pieces."""
        out = sym - self.top
        inner = sym < self.top
        out[inner] = [self.inner_chars[i] for i in sym[inner].tolist()]
        return out

    def learn(self, data: np.ndarray, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments (bytes, spaces still as spaces), and whether the library gives the same: the last id of a
        segment is followed by AGREES or DIFFERS."""
        text = data.tobytes().decode("utf-8")
        size = np.add.reduceat((data & 0xC0) != 0x80, np.cumsum(n_bytes) - n_bytes, dtype=np.int64)
        sym = self.symbol_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(size)
        starts = ends - size
        long = np.flatnonzero(size > SHORT)
        parts = [(long[i], np.array(self.merge_heap(sym[starts[j] : ends[j]].tolist()), np.int32)) for i, j in enumerate(long)]
        short = np.flatnonzero(size <= SHORT)
        flats, sizes, owners = [p for _, p in parts], [np.array([len(p) for _, p in parts], np.int64)], [long]
        for a in range(0, len(short), GROUP):
            idx = short[a : a + GROUP]
            f, s = self.merge_many(gather(sym, starts[idx], size[idx]), size[idx])
            flats.append(f)
            sizes.append(s)
            owners.append(idx)
        flat, count, who = np.concatenate(flats), np.concatenate(sizes), np.concatenate(owners)
        order = np.argsort(who)
        first = np.cumsum(count) - count
        flat, count = self.spell(gather(flat, first[order], count[order]), count[order])
        # the library on the same segments, without its own leading space (a lone space is an empty text to it)
        bounds = zip(starts.tolist(), ends.tolist(), strict=True)
        theirs = self.library.encode([text[a + 1 : b] for a, b in bounds], num_threads=1)
        n_theirs = np.array([len(t) for t in theirs])
        lone = (size == 1) & (data[np.cumsum(n_bytes) - 1] == 32)
        same = (n_theirs == count) | lone
        if same.all() and not lone.any():
            flat_theirs = np.fromiter(chain.from_iterable(theirs), np.int32, int(n_theirs.sum()))
            same &= np.add.reduceat(flat_theirs != flat, np.cumsum(count) - count) == 0
        else:
            mine = np.split(flat, np.cumsum(count)[:-1])
            same &= np.array([bool(x) or m.tolist() == t for m, t, x in zip(mine, theirs, lone, strict=True)])
        out = np.insert(flat, np.cumsum(count), np.where(same, AGREES, DIFFERS))
        return out, count + 1

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of the score, merged piece) of symbol pairs; rank 0: they do not merge."""
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], np.int32(0)), self.to[at]


class Encoder:
    """Encodes the texts of a column; distinct segments are merged once while the coder holds them."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.coder = SpanCoder(self.model.learn)
        digits = [str(i) for i in range(self.model.n_pieces)]
        self.n_digits = np.array([len(d) + 1 for d in digits])
        width = int(self.n_digits.max())
        self.digits = np.frombuffer("".join(d.ljust(width) for d in (x + "," for x in digits)).encode(), np.uint8).reshape(-1, width)

    @staticmethod
    def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with a space before each text that is not empty, starts, ends, first segment of each text)."""
        full = offsets[1:] > offsets[:-1]
        shift = np.concatenate([[0], np.cumsum(full)])
        out = np.full(len(data) + int(shift[-1]), 32, np.uint8)
        out[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
        offsets = offsets + shift
        cut = out == 32
        cut[1:] &= out[:-1] != 32
        # a space after a literal lower block is one more of a run of spaces
        low = np.flatnonzero((out[2:] == 0x81) & (out[1:-1] == 0x96) & (out[:-2] == 0xE2)) + 3
        cut[low[low < len(out)]] = False
        cut[offsets[:-1][full]] = True
        starts = np.flatnonzero(cut)
        return out, starts, np.append(starts[1:], len(out)) if len(starts) else starts, np.searchsorted(starts, offsets)

    def encode(self, col: pa.Array):
        """(ids of each text, decimal ids joined by commas, whether the library agrees on all of its segments)."""
        data, offsets = text_buffers(col)
        ids, texts, agrees = [], [], []
        for a, b in chunks(offsets, CHUNK):
            out, starts, ends, first = self.segments(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            flat, sizes = self.coder.code(out, starts, ends)
            bounds = np.concatenate([[0], np.cumsum(sizes)])[first]
            mark = flat < 0
            odd = np.concatenate([[0], np.cumsum(flat == DIFFERS)])[bounds]
            agrees.append(odd[1:] == odd[:-1])
            bounds = bounds - np.concatenate([[0], np.cumsum(mark)])[bounds]
            flat = flat[~mark]
            n = self.n_digits[flat]
            at = np.concatenate([[0], np.cumsum(n)])[bounds].tolist()
            written = self.digits[flat][np.arange(self.digits.shape[1]) < n[:, None]].tobytes().decode("ascii")
            texts += [written[x : max(x, y - 1)] for x, y in zip(at[:-1], at[1:], strict=True)]
            whole, cuts = flat.tolist(), bounds.tolist()
            ids += [whole[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return ids, texts, np.concatenate(agrees) if agrees else np.zeros(0, bool)


def model_file(spark, path: str) -> str:
    """Name under which the executors find the model file (sent with the job)."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, slice_rows: int = 1024) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded, agrees): ids as decimal numbers joined by commas.

    ``model``: path of the model file on the driver.
    """
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()
    name = model_file(docs.sparkSession, model)

    def run(batches):
        enc = kept_in_worker(f"pieces {name}", lambda: Encoder(SparkFiles.get(name)))
        for batch in batches:
            for a in range(0, len(batch), slice_rows):
                rows = batch.slice(a, slice_rows)
                ids, texts, agrees = enc.encode(rows.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(texts, pa.string()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array(enc.model.library.decode(ids, num_threads=1), pa.string()), pa.array(agrees)],
                    names=["doc_id", "ids", "n_tokens", "decoded", "agrees"])

    return part.mapInArrow(releasing(run), f"doc_id {kind}, ids string, n_tokens long, decoded string, agrees boolean")
