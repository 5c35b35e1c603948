"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of tokens.

Pieces are placed longest first.  A group's bins stand in order of their residual; for a piece the search starts at the
tightest bin that holds it and goes on to the next larger residual until a bin is compatible.  Each bin
carries two bitmaps: sources and duplicate clusters of what it holds.  A piece never joins a bin that has its
duplicate cluster, nor one that has its source already.  Where no bin is left it opens a new one.

A document longer than a bin is cut: full bins, and a rest that is packed like any other piece.  Documents are dealt to
groups by a hash of id, length and cluster, some ``group_docs`` to a group, so neither a hot source nor a large cluster, nor rows of one
or no id, meet in one task; only ids, lengths and names are shuffled.

A null source or cluster conflicts with nothing.  A null or negative length counts as 0; a document of length 0 is one
empty piece.  Rows of one id are packed as documents of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.ngram_join import BROADCAST_ROWS, linked_classes
from lakeops.llm.spans import kept_in_worker
from lakeops.llm.token_file import WordTokenizer
from lakeops.llm.words import releasing

CAPACITY = 2048
GROUP_DOCS = 8192
PIECE_SCHEMA = "doc_id long, piece long, start long, n_tokens long, bin long, position long, source string, cluster long"


def measured(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, n_tokens, source, cluster): ids of the whole text with an end id; cluster: name of its component in the n-gram join.

    Near copies (Jaccard 0.75 or more of their 5-word shingles) and what they link are one cluster; a text without words has none.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"))

    def tokens(texts):
        tok = kept_in_worker(f"tokens {name}", lambda: WordTokenizer(SparkFiles.get(name)))
        return [pa.array(tok.counts(texts) + 1)]

    # the scan that finds the join's classes counts the tokens too
    sized, _, labels = linked_classes(part, measure=tokens, measures=("n_tokens",))
    # joined by class and not by id, which may be null or repeated; the names (16 bytes) are sent to all tasks if they are few
    few = labels.count() <= BROADCAST_ROWS
    joined = sized.join(F.broadcast(labels) if few else labels, F.col("cls") == F.col("vertex"), "left")
    return joined.select("doc_id", "n_tokens", "source", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("cluster"))


class Bins:
    """Bins in order of residual, with the sources and clusters each holds as bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin) of the bins with room
        self.residual: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, position) of the tightest compatible bin; source and cluster are bit masks."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            b = self.order[at][1]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                break
            at += 1
        if at < len(self.order):
            _, b = self.order.pop(at)
        else:
            b = len(self.residual)
            self.residual.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        position = self.capacity - self.residual[b]
        self.residual[b] -= size
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if self.residual[b]:
            insort(self.order, (self.residual[b], b))
        return b, position


def _masks(values: list, shared_only: bool) -> list[int]:
    """A bit for each distinct value; 0 for null and, if asked, for values that occur once and so cannot conflict."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    bits: dict = {None: 0}
    for v, n in count.items():
        if v is not None:
            bits[v] = 0 if shared_only and n == 1 else 1 << len(bits)
    return [bits[v] for v in values]


def packer(capacity: int):
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("n_tokens", "descending"), ("source", "ascending"), ("cluster", "ascending")])
        ids, sizes, sources, clusters = (t.column(c).to_pylist() for c in ("doc_id", "n_tokens", "source", "cluster"))
        group = t.column("pack_group")[0].as_py()
        source_bits, cluster_bits = _masks(sources, False), _masks(clusters, True)
        pieces = []  # (size, row, piece, start)
        for i, n in enumerate(sizes):
            n = max(0, n or 0)
            full, rest = divmod(n, capacity)
            pieces += [(capacity, i, k, k * capacity) for k in range(full)]
            if rest or not full:
                pieces.append((rest, i, full, full * capacity))
        pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
        bins, out = Bins(capacity), []
        for size, i, k, start in pieces:
            b, position = bins.place(size, source_bits[i], cluster_bits[i])
            out.append((ids[i], k, start, size, (group << 32) + b, position, sources[i], clusters[i]))
        names = ["doc_id", "piece", "start", "n_tokens", "bin", "position", "source", "cluster"]
        return pa.table([pa.array(c, pa.string() if n == "source" else pa.int64()) for n, c in zip(names, zip(*out, strict=True), strict=True)], names=names)

    return pack


def best_fit(sized: DataFrame, n_docs: int, *, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin, position, source, cluster): where each piece lies.

    sized: doc_id, n_tokens, source, cluster; n_docs: its number of rows (about), which sets the number of groups.
    """
    groups = max(1, -(-n_docs // group_docs))
    dealt = sized.select("doc_id", "n_tokens", "source", "cluster", F.pmod(F.xxhash64("doc_id", "n_tokens", "cluster"), F.lit(groups)).alias("pack_group"))
    return dealt.groupBy("pack_group").applyInArrow(releasing(packer(capacity)), PIECE_SCHEMA)
