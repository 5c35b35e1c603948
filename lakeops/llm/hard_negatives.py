"""Hard-negative mining by exact integer inner products, several candidates to a multiplication.

Vectors become integer vectors.  Of a pair of an anchor and a positive (one of the rows nearest to the anchor among those of its
label) the hard negatives are the nearest rows of other labels whose score lies in a band of the positive's score.

Kronecker packing: the components of some candidates are biased to be non-negative and put side by side into fields of one wide
integer.  The fields are as wide as the largest sum can get, so no field runs into the next, and one multiplication by an
(also biased) component of the anchor serves all of them.  Summed over the components, the fields hold the biased scores;
taking them out and taking the bias off gives the scores exactly.  A wide integer of up to 53 bits is held exactly by a double,
so the products of a block are a matrix product; where a single score needs more, wide integers are Python's, without a bound.

How it is split: vectors are packed into blocks.  Anchors go in groups, candidate blocks in slices, and each group meets each
slice once, in a task of its own that sees one group and one slice, tile by tile, and keeps the first few rows per
anchor.  What is shuffled are blocks, not rows.  Slices are by number of rows, so a label, or a vector that many rows
share, meets in no task; a group's results are joined by a window over a few rows a slice.

Rows with a null label, vector, or id, or an entry that is null or not finite, take no part.  A vector shorter than others counts as filled up
with zeros.  Repeated rows count one by one: a copy of an anchor is a row of its own, is an anchor too, and can be the other's positive.
Ties go by the id.  A score beyond a long raises OverflowError.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.staging import staged
from lakeops.llm.vectors import BLOCK_ROWS, blocks, is_finite_vector, matrix, packed, widened
from lakeops.llm.words import releasing

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, BASE = 30, 90, 100  # LOW * positive <= BASE * negative <= HIGH * positive
GROUP_ENTRIES = 1 << 20  # entries of the anchors of a task: 16,384 vectors of 64
SLICE_ENTRIES = 1 << 24  # entries of the candidates of a task: 262,144 vectors of 64
TILE = 1024  # anchors by candidates that are multiplied at once
DOUBLE_BITS, WIDE_FIELDS = 53, 64
BLOCK_BITS = 12  # a row's number: block << BLOCK_BITS | place
FOUND = "anchor long, anchor_id long, grp int, bound long, score long, other_id long, other long"


# --- packed products -----------------------------------------------------------------------------
class PackedProducts:
    """Scores of anchors (m x d integers) with candidates (n x d) by products of packed candidates."""

    def __init__(self, anchors: np.ndarray):
        anchors = anchors.astype(np.int64)
        self.bias = -min(0, int(anchors.min(initial=0)))
        self.raw, self.dim = anchors, anchors.shape[1]
        self.top = int(anchors.max(initial=0)) + self.bias
        self.doubles = (anchors + self.bias).astype(np.float64) if self.top < 2**DOUBLE_BITS else None
        self.sums = [sum(r) + self.dim * self.bias for r in anchors.tolist()]

    def scores(self, candidates: np.ndarray) -> np.ndarray:
        low, high = int(candidates.min(initial=0)), int(candidates.max(initial=0))
        bias = -min(0, low)
        shifted = candidates.astype(np.int64 if high + bias < 2**62 else object) + bias
        bits = max(1, (self.top * int(shifted.max(initial=0)) * max(1, self.dim)).bit_length())
        fields = DOUBLE_BITS // bits
        got = self._in_doubles(shifted, bits, fields) if fields else self._in_wide_integers(shifted, bits)
        # sum (a + s)(c + t) = score + t * sum(a + s) + s * sum(c + t) - d * s * t
        if fields:
            rows = np.array(self.sums, np.int64)[:, None] * bias - self.dim * self.bias * bias
            return got - rows - self.bias * shifted.sum(axis=1)[None, :]
        columns = [sum(c) for c in shifted.tolist()]
        exact = [[s - bias * a - self.bias * c + self.dim * self.bias * bias for s, c in zip(row, columns, strict=True)] for row, a in zip(got, self.sums, strict=True)]
        return np.array(exact, np.int64).reshape(len(exact), len(columns))  # beyond a long: OverflowError

    def _in_doubles(self, shifted: np.ndarray, bits: int, fields: int) -> np.ndarray:
        """``fields`` candidates to a double; all partial sums are integers below 2**53, hence exact."""
        n = -(-len(shifted) // fields)
        wide = np.zeros((n, self.dim), np.int64)
        for f in range(fields):
            part = shifted[f * n : (f + 1) * n]
            wide[: len(part)] |= part << (f * bits)
        product = (self.doubles @ wide.astype(np.float64).T).astype(np.int64)
        mask = (1 << bits) - 1
        return np.concatenate([(product >> (f * bits)) & mask for f in range(fields)], axis=1)[:, : len(shifted)]

    def _in_wide_integers(self, shifted: np.ndarray, bits: int) -> list[list[int]]:
        anchors = (self.raw.astype(object) + self.bias).tolist()
        mask, out = (1 << bits) - 1, [[] for _ in anchors]
        for at in range(0, len(shifted), WIDE_FIELDS):
            part = shifted[at : at + WIDE_FIELDS].tolist()
            wide = [sum(c << (f * bits) for f, c in enumerate(column)) for column in zip(*part, strict=True)]
            for row, a in zip(out, anchors, strict=True):
                product = sum(x * w for x, w in zip(a, wide, strict=True))
                row += [(product >> (f * bits)) & mask for f in range(len(part))]
        return out


# --- the first few of each row -------------------------------------------------------------------
class Firsts:
    """The first ``k`` candidates of each of n rows by falling score, then id, then number; candidates come in that order of
    (id, number), so that one with the score of the last place never takes it."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.row, self.score, self.id, self.number = (np.zeros(0, np.int64) for _ in range(4))
        self.least = np.full(n, np.iinfo(np.int64).min)  # a score must be over that
        self.full = np.zeros(n, bool)

    def add(self, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        ok &= (scores > self.least[:, None]) | ~self.full[:, None]
        row, at = np.nonzero(ok)
        if not len(row):
            return
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, scores[row, at]])
        id_, number = np.concatenate([self.id, ids[at]]), np.concatenate([self.number, numbers[at]])
        order = np.lexsort((number, id_, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = order[place < self.k]
        self.row, self.score, self.id, self.number = row[place < self.k], score[keep], id_[keep], number[keep]
        last = place == self.k - 1
        self.least[row[last]] = score[order[last]]
        self.full[row[last]] = True


def _rows(blocks_: list[dict]) -> dict[str, np.ndarray]:
    """All rows of some blocks, by (id, number)."""
    width = max((b["dim"] for b in blocks_), default=0)
    got = {"x": np.concatenate([matrix(b["code"], b["entries"], b["size"], b["dim"], width) for b in blocks_]),
           **{k: np.concatenate([np.array(b[k], np.int64) for b in blocks_]) for k in ("ids", "labels", "numbers")}}
    order = np.lexsort((got["numbers"], got["ids"]))
    return {k: v[order] for k, v in got.items()}


def _numbered(b: dict) -> dict:
    return b | {"numbers": (b["block"] << BLOCK_BITS) + np.arange(b["size"])}


def _aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return widened(a, width), widened(b, width)


def _found(anchors: dict, grp: int, rows: np.ndarray, bounds: np.ndarray, firsts: Firsts) -> pa.Table:
    of = rows[firsts.row]
    return pa.table([pa.array(anchors["numbers"][of], pa.int64()), pa.array(anchors["ids"][of], pa.int64()), pa.array(np.full(len(of), grp), pa.int32()),
                     pa.array(bounds[firsts.row], pa.int64()), pa.array(firsts.score, pa.int64()), pa.array(firsts.id, pa.int64()), pa.array(firsts.number, pa.int64())],
                    names=["anchor", "anchor_id", "grp", "bound", "score", "other_id", "other"])


def _cell(t: pa.Table) -> tuple[int, dict | None, dict | None, list]:
    """(group, anchors, candidates, (anchor number, bound) pairs) of a task's rows."""
    got = t.to_pylist()
    anchors, others = ([b for b in got if b["kind"] == k] for k in (0, 1))
    wanted = [(w["anchor"], w["bound"]) for b in got if b["kind"] == 2 for w in b["wanted"]]
    return got[0]["grp"], _rows(anchors) if anchors else None, _rows([_numbered(b) for b in others]) if others else None, wanted


def nearest_of_label(k: int):
    """The first k other rows of an anchor's label, in a slice; anchors and candidates meet label by label."""

    def work(t: pa.Table) -> pa.Table:
        grp, anchors, others, _ = _cell(t)
        parts = [_found({c: np.zeros(0, np.int64) for c in ("numbers", "ids")}, grp, np.zeros(0, np.int64), np.zeros(0, np.int64), Firsts(0, k))]
        if anchors is None or others is None:
            return parts[0]
        xa, xc = _aligned(anchors["x"], others["x"])
        by = np.argsort(others["labels"], kind="stable")  # within a label still by (id, number)
        labels = others["labels"][by]
        for label in np.unique(anchors["labels"]).tolist():
            rows, cand = np.flatnonzero(anchors["labels"] == label), by[np.searchsorted(labels, label) : np.searchsorted(labels, label, "right")]
            for a in range(0, len(rows), TILE):
                tile = rows[a : a + TILE]
                products, firsts = PackedProducts(xa[tile]), Firsts(len(tile), k)
                for c in range(0, len(cand), TILE):
                    at = cand[c : c + TILE]
                    other = anchors["numbers"][tile][:, None] != others["numbers"][at][None, :]
                    firsts.add(products.scores(xc[at]), other, others["ids"][at], others["numbers"][at])
                parts.append(_found(anchors, grp, tile, np.zeros(len(tile), np.int64), firsts))
        return pa.concat_tables(parts)

    return work


def nearest_in_band(k: int, low: int, high: int, base: int):
    """The first k rows of other labels of each (anchor, positive score), whose score is in the band, in a slice."""

    def work(t: pa.Table) -> pa.Table:
        grp, anchors, others, wanted = _cell(t)
        parts = [_found({c: np.zeros(0, np.int64) for c in ("numbers", "ids")}, grp, np.zeros(0, np.int64), np.zeros(0, np.int64), Firsts(0, k))]
        if anchors is None or others is None or not wanted:
            return parts[0]
        xa, xc = _aligned(anchors["x"], others["x"])
        place = {n: i for i, n in enumerate(anchors["numbers"].tolist())}
        # by anchor; of an anchor's distinct bounds one goes to each layer, so that a tile's products serve all layers
        of: dict[int, list[int]] = {}
        for anchor, bound in sorted(set(wanted)):
            of.setdefault(place[anchor], []).append(bound)
        rows = np.array(sorted(of), np.int64)
        for a in range(0, len(rows), TILE):
            tile = rows[a : a + TILE]
            products, layers = PackedProducts(xa[tile]), []
            for i in range(max(len(of[r]) for r in tile.tolist())):
                own = np.flatnonzero([len(of[r]) > i for r in tile.tolist()])
                bounds = [of[r][i] for r in tile[own].tolist()]
                # low * p <= base * s <= high * p, in whole scores
                least = np.array([-(-low * p // base) for p in bounds], np.int64)
                most = np.array([high * p // base for p in bounds], np.int64)
                layers.append((own, np.array(bounds, np.int64), least, most, Firsts(len(own), k)))
            for c in range(0, len(others["ids"]), TILE):
                at = slice(c, c + TILE)
                scores = products.scores(xc[at])
                differ = anchors["labels"][tile][:, None] != others["labels"][at][None, :]
                for own, _, least, most, firsts in layers:
                    s = scores if len(own) == len(tile) else scores[own]
                    d = differ if len(own) == len(tile) else differ[own]
                    firsts.add(s, d & (s >= least[:, None]) & (s <= most[:, None]), others["ids"][at], others["numbers"][at])
            parts += [_found(anchors, grp, tile[own], bounds, firsts) for own, bounds, _, _, firsts in layers]
        return pa.concat_tables(parts)

    return work


# --- jobs ----------------------------------------------------------------------------------------
def _anchors(batches):
    """Of each block, its marked rows as a block of their own, with their numbers."""
    for batch in batches:
        for b in batch.to_pylist():
            at = np.flatnonzero(np.array(b["marks"], bool))
            if len(at):
                code, entries = packed(matrix(b["code"], b["entries"], b["size"], b["dim"], b["dim"])[at])
                yield pa.RecordBatch.from_pylist([{
                    "size": len(at), "dim": b["dim"], "ids": np.array(b["ids"])[at].tolist(), "labels": np.array(b["labels"])[at].tolist(),
                    "numbers": ((b["block"] << BLOCK_BITS) + at).tolist(), "code": code, "entries": entries}], ANCHOR_ARROW)


ANCHOR_SCHEMA = "size long, dim int, ids array<long>, labels array<long>, numbers array<long>, code string, entries binary"
_LONGS = pa.list_(pa.int64())
ANCHOR_ARROW = pa.schema([("size", pa.int64()), ("dim", pa.int32()), ("ids", _LONGS), ("labels", _LONGS), ("numbers", _LONGS), ("code", pa.string()), ("entries", pa.binary())])


def _spread(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _first(found: DataFrame, key: list[str], k: int) -> DataFrame:
    """The first k of each key over all slices, with their ``rank``."""
    w = Window.partitionBy(*key).orderBy(F.col("score").desc(), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, scale: float = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int, int] = (LOW, HIGH, BASE)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors and positives.

    is_anchor: a condition on columns of ``rows``; entries count as floor(scale * entry), in doubles.  Other columns are not read.
    """
    part = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                       F.col(label_col).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("mark"))
    part = part.filter("id IS NOT NULL AND label IS NOT NULL").filter(is_finite_vector(F.col("vector")))
    all_ = blocks(part, lambda x: np.floor(scale * x), "negatives-blocks", min(BLOCK_ROWS, 1 << BLOCK_BITS))
    n, dim = (v or 0 for v in all_.agg(F.sum("size"), F.max("dim")).first())
    anchors = staged(all_.mapInArrow(releasing(_anchors), ANCHOR_SCHEMA).withColumn("part", F.monotonically_increasing_id()), "negatives-anchors")
    n_anchors = anchors.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-n_anchors * dim // GROUP_ENTRIES))
    slices = max(1, -(-n * dim // SLICE_ENTRIES), min(12, -(-n // BLOCK_ROWS)))

    def deal(number: str, into: int) -> Column:
        return F.pmod(F.xxhash64(number), F.lit(into)).cast("int")

    no = lambda kind: F.lit(None).cast(kind)
    columns = ["kind", "grp", "slice", "size", "dim", "ids", "labels", "numbers", "block", "code", "entries", "wanted"]
    wanted_kind = "array<struct<anchor:bigint,bound:bigint>>"
    left = (anchors.withColumns({"kind": F.lit(0), "grp": deal("part", groups), "block": no("long"), "wanted": no(wanted_kind)})
            .withColumn("slice", _spread(slices)).select(*columns))
    right = (all_.withColumns({"kind": F.lit(1), "slice": deal("block", slices), "numbers": no("array<long>"), "wanted": no(wanted_kind)})
             .withColumn("grp", _spread(groups)).select(*columns))
    cells = left.union(right)
    near = cells.groupBy("grp", "slice").applyInArrow(releasing(nearest_of_label(positives)), FOUND)
    chosen = staged(_first(near, ["anchor"], positives).select("anchor", "anchor_id", "grp", F.col("score").alias("bound"), F.col("other_id").alias("positive_id")), "negatives-positives")
    # the scores that a group asks for, some of each anchor: one row a group, bounded by its anchors, sent to all slices
    asked = chosen.select("grp", "anchor", "bound").distinct().groupBy("grp").agg(F.collect_list(F.struct("anchor", "bound")).alias("wanted"))
    asked = (asked.withColumns({"kind": F.lit(2), "slice": _spread(slices), "size": no("long"), "dim": no("int"), "block": no("long"), "code": no("string"), "entries": no("binary"),
                                **{c: no("array<long>") for c in ("ids", "labels", "numbers")}}).select(*columns))
    in_band = cells.union(asked).groupBy("grp", "slice").applyInArrow(releasing(nearest_in_band(negatives, *band)), FOUND)
    first = _first(in_band, ["anchor", "bound"], negatives).select("anchor", "bound", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return chosen.join(first, ["anchor", "bound"]).select("anchor_id", "positive_id", "rank", "negative_id", F.col("bound").alias("positive_score"), "negative_score")


ORACLE = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
