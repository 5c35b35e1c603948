"""Substring dedup: repeated stretches of ``window`` words, found in prefix-partitioned sparse suffix trees.

A window (35 consecutive words of a document) is repeated if its word sequence also
starts anywhere else, in the same document or another.  Every word that a repeated
window covers is removed.  All windows are judged on the input.

1. Each window has an anchor: the leftmost of its 12-word prefixes-to-be with the lowest hash, so equal windows
   have equal anchors at equal places.  A scan counts anchors; a bitmap of fixed size says which occur at least twice.
   Suffixes at other anchors cannot belong to a repeated window and are left out.
2. A second scan sends, for each suffix at a live anchor, the words of the windows around it, once per task and content.
   Suffixes are partitioned by their prefix (the anchor), in groups sized for memory.  Where a prefix is too
   frequent it is extended: up to the whole window, whose copies are counted and not gathered.
3. Each task builds the suffix trees of its prefixes, as the sorted suffixes with the depths of the nodes between
   neighbours.  For each distance from the start of a window to its anchor, the leaves below one node that is deep enough and
   that agree to the left of the anchor are copies of one window.
4. The repeated contents are joined back to their places; one pass over the texts drops the covered words.

Words are maximal runs of anything but ASCII white space, unchanged.  Sequences are compared by the 64 bits of their
anchor's 12 words and 32 bits for each of the 23 or more others, contents by 128 bits.  Null and empty texts have no words; a text shorter than a window
keeps all of its words.  Repeated rows are documents of their own, and so repeat each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.spans import gather
from lakeops.llm.staging import staged
from lakeops.llm.words import MULT_WORDS, Hasher, mix, releasing, word_chunks

WINDOW = 35
ANCHOR = 12
BITMAP_BITS = 26  # 8 MB, whatever the input
FLUSH_ANCHORS = 1_000_000
FLUSH_ROWS = 30_000  # suffixes (about 210 bytes each) that a task gathers before it writes
GROUP_ROWS = 50_000  # expected suffixes of a group
FREQUENT = 20_000  # occurrences from which on a prefix is extended to whole windows
MAX_FREQUENT = 1 << 16  # longest list of them (512 KB sent to the tasks); a prefix beyond it stays with its group
PLACES = 20_000  # places of a row (36 bytes each)


def block_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


class Anchors:
    """Anchors of the windows of a chunk: positions, keys, and the distances to the starts of their windows."""

    def __init__(self, hasher: Hasher, words, window: int = WINDOW, anchor: int = ANCHOR):
        self.words, n = words, len(words.hashes)
        docs = words.docs()
        starts = np.arange(max(0, n - window + 1))
        starts = starts[docs[starts] == docs[starts + window - 1]] if len(starts) else starts
        if not len(starts):
            self.at, self.keys, self.near, self.far, self.doc = (np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
            return
        grams = mix(hasher.windows(words.hashes, anchor))
        # leftmost minimum of the window's anchor candidates, by doubling
        span, width = window - anchor + 1, 1
        low, place = grams, np.arange(len(grams), dtype=np.int32)
        while 2 * width <= span:
            low, place = self._lower(low, place, width)
            width *= 2
        if width < span:
            low, place = self._lower(low, place, span - width)
        q = place[starts].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1])]))
        last = np.append(first[1:], len(q)) - 1
        self.at, self.keys = q[first], grams[q[first]]
        self.far, self.near = self.at - starts[first], self.at - starts[last]  # largest and smallest distance
        self.doc = docs[self.at]

    @staticmethod
    def _lower(low, place, step):
        a, b = low[:-step], low[step:]
        right = b < a
        return np.where(right, b, a), np.where(right, place[step:], place[:-step])


# --- 1. live anchors ---------------------------------------------------------------------
def anchor_counts(docs: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block of the anchor space: its slice of the bitmap, occurrences of live anchors, frequent anchors."""

    def scan(batches):
        hasher, held, size = Hasher(), [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(block_of(keys, n_blocks), np.arange(n_blocks + 1))
            rows = [(i, keys[a:b].tobytes() + counts[a:b].astype(np.uint64).tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "blob"])

        for batch in batches:
            for _, _, _, _, w in word_chunks(hasher, batch.column("text")):
                keys = Anchors(hasher, w).keys
                held.append(keys)
                size += len(keys)
                if size >= FLUSH_ANCHORS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    slice_bits = (1 << BITMAP_BITS) // n_blocks

    def count(t: pa.Table) -> pa.Table:
        block = t.column("block")[0].as_py()
        both = [np.frombuffer(b.as_py(), np.uint64).reshape(2, -1) for b in t.column("blob")]
        keys, counts = np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])
        keys, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, counts.astype(np.float64), len(keys)).astype(np.int64)
        live = counts >= 2
        bits = np.zeros(slice_bits, np.uint8)
        bits[(keys[live] >> np.uint64(64 - BITMAP_BITS)).astype(np.int64) - block * slice_bits] = 1
        often = np.flatnonzero(counts >= FREQUENT)
        often = often[np.argsort(-counts[often], kind="stable")][: MAX_FREQUENT // n_blocks]
        return pa.table({"block": pa.array([block]), "bitmap": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                         "rows": pa.array([int(counts[live].sum())]), "often": pa.array([keys[often].tobytes()], pa.binary())})

    part = docs.select("text").mapInArrow(releasing(scan), "block long, blob binary")
    return part.groupBy("block").applyInArrow(releasing(count), "block long, bitmap binary, rows long, often binary")


# --- 2. suffixes ---------------------------------------------------------------------------
class Suffixes:
    """Columns of the blob of a group: key, near, far, copies in the task, two content hashes, words before and after the anchor.

    The anchor's own words are the same wherever its key is, and stay behind.
    """

    WIDTH = 2 * (WINDOW - ANCHOR)

    @classmethod
    def kind(cls) -> np.dtype:
        return np.dtype([("key", "<u8"), ("c1", "<u8"), ("c2", "<u8"), ("near", "u1"), ("far", "u1"), ("many", "u1"), ("whole", "u1"), ("words", "<u4", (cls.WIDTH,))])


WHOLE = np.dtype([("c1", "<u8"), ("c2", "<u8"), ("many", "u1")])
PLACE = np.dtype([("c1", "<i8"), ("c2", "<i8"), ("doc", "<i8"), ("sha", "<i8"), ("at", "<i4")])


def _twice(hasher: Hasher, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row of a matrix of words."""
    up, other = hasher.powers(MULT_WORDS, seq.shape[1])[0], hasher.powers(0xA0761D6478BD642F, seq.shape[1])[0]
    wide = seq.astype(np.uint64)
    return mix((wide * up).sum(axis=1, dtype=np.uint64)), mix((wide * other).sum(axis=1, dtype=np.uint64))


def suffixes(docs: DataFrame, live, often, n_blocks: int) -> DataFrame:
    """(block, kind, blob): kind 0 suffixes of a group, kind 1 whole windows of frequent prefixes, kind 2 places of contents."""
    left = WINDOW - ANCHOR

    def scan(batches):
        hasher = Hasher()
        bitmap, frequent = np.frombuffer(live.value, np.uint8), often.value
        tree, whole, places, held = [], [], [], 0

        def flush():
            rows = []
            for kind, parts, dtype in ((0, tree, Suffixes.kind()), (1, whole, WHOLE)):
                if not parts:
                    continue
                all_ = np.concatenate(parts)
                # one of each content, marked if the task has more
                _, first, n = np.unique(all_["c1"], return_index=True, return_counts=True)
                once = all_[first]
                once["many"] = n > 1
                blocks = block_of(mix(once["key"] if kind == 0 else once["c1"]), n_blocks)
                order = np.argsort(blocks, kind="stable")
                once, blocks = once[order], blocks[order]
                cuts = np.searchsorted(blocks, np.arange(n_blocks + 1))
                rows += [(i, kind, once[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            if places:
                raw = np.concatenate(places)
                rows += [(-1, 2, raw[i : i + PLACES].tobytes()) for i in range(0, len(raw), PLACES)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                                              names=["block", "kind", "blob"])

        def place(c1, c2, doc, sha, at):
            out = np.zeros(len(at), PLACE)
            out["c1"], out["c2"], out["doc"], out["sha"], out["at"] = c1.astype(np.int64), c2.astype(np.int64), doc, sha, at
            places.append(out)

        for batch in batches:
            ids = batch.column("doc").to_numpy()
            shas = batch.column("sha").to_numpy()
            for a, _, _, _, w in word_chunks(hasher, batch.column("text")):
                an = Anchors(hasher, w)
                bit = (an.keys >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                idx = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                if not len(idx):
                    continue
                short = (w.hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # never 0, the padding
                local = an.at - w.offsets[an.doc]  # place of the anchor in its document
                at = np.minimum(np.searchsorted(frequent, an.keys[idx]), max(len(frequent) - 1, 0))
                is_frequent = frequent[at] == an.keys[idx] if len(frequent) else np.zeros(len(idx), bool)
                rare, common = idx[~is_frequent], idx[is_frequent]
                if len(rare):
                    cols = np.arange(-left, WINDOW)
                    pos = an.at[rare][:, None] + cols
                    # the words that windows of this anchor cover; the rest is padding
                    inside = (cols >= -an.far[rare][:, None]) & (cols < WINDOW - an.near[rare][:, None])
                    seq = np.where(inside, short[np.clip(pos, 0, len(short) - 1)], np.uint32(0))
                    out = np.zeros(len(rare), Suffixes.kind())
                    out["key"], out["near"], out["far"] = an.keys[rare], an.near[rare], an.far[rare]
                    out["words"] = seq[:, (cols < 0) | (cols >= ANCHOR)]
                    c1, c2 = _twice(hasher, seq)
                    span = (an.near[rare] * 64 + an.far[rare]).astype(np.uint64)
                    out["c1"], out["c2"] = c1 + span, c2 + span
                    tree.append(out)
                    place(out["c1"], out["c2"], ids[a + an.doc[rare]], shas[a + an.doc[rare]], local[rare])
                    held += len(rare)
                if len(common):
                    n = an.far[common] - an.near[common] + 1
                    which = np.repeat(common, n)
                    begin = an.at[which] - an.far[which] + (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n))
                    out = np.zeros(len(which), WHOLE)
                    out["c1"], out["c2"] = _twice(hasher, short[begin[:, None] + np.arange(WINDOW)])
                    whole.append(out)
                    place(out["c1"], out["c2"], ids[a + an.doc[which]], shas[a + an.doc[which]], begin - w.offsets[an.doc[which]])
                    held += len(which) // 4
                if held >= FLUSH_ROWS:
                    yield flush()
                    tree, whole, places, held = [], [], [], 0
        if places:
            yield flush()

    return docs.mapInArrow(releasing(scan), "block long, kind int, blob binary")


# --- 3. suffix trees -----------------------------------------------------------------------
def repeated_windows(rows: np.ndarray) -> np.ndarray:
    """For each suffix, a bit mask: bit d is set if the window that starts d words before its anchor is repeated.

    rows: distinct contents (Suffixes) with ``many`` set where a content has copies.
    """
    left = WINDOW - ANCHOR
    masks = np.zeros(len(rows), np.int64)
    right = rows["words"][:, left:]
    order = np.lexsort((*right.T[::-1], rows["key"]))
    rows, right = rows[order], right[order]
    # depth of the node between neighbours: words that their suffixes share
    differs = right[1:] != right[:-1]
    depth = np.where(differs.any(axis=1), ANCHOR + differs.argmax(axis=1), WINDOW)
    depth[rows["key"][1:] != rows["key"][:-1]] = 0
    before = np.zeros(len(rows), np.uint64)
    for d in range(left + 1):
        if d:
            before = mix(before * np.uint64(MULT_WORDS) + rows["words"][:, left - d].astype(np.uint64))
        node = np.concatenate([[0], np.cumsum(depth < WINDOW - d)])
        at = np.flatnonzero((rows["near"] <= d) & (d <= rows["far"]))
        if not len(at):
            continue
        same = mix(before[at] + node[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, where, n = np.unique(same, return_inverse=True, return_counts=True)
        masks[order[at[(n[where] > 1) | (rows["many"][at] > 0)]]] |= 1 << d
    return masks


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """One row per content, ``many`` set if any task has several or several tasks have it."""
    all_ = np.concatenate(parts)
    order = np.lexsort((all_["c2"], all_["c1"]))
    all_ = all_[order]
    new = np.concatenate([[True], (all_["c1"][1:] != all_["c1"][:-1]) | (all_["c2"][1:] != all_["c2"][:-1])])
    first = np.flatnonzero(new)
    many = np.add.reduceat(all_["many"].astype(np.int64), first) + np.diff(np.append(first, len(all_))) > 1
    out = all_[first].copy()
    out["many"] = many
    return out


def trees(t: pa.Table) -> pa.Table:
    """Repeated contents of a group with their masks."""
    blobs: dict[int, list] = {}
    for kind, blob in zip(t.column("kind").to_pylist(), t.column("blob"), strict=True):
        blobs.setdefault(kind, []).append(blob.as_py())
    out = []
    if 0 in blobs:
        rows = _distinct([np.frombuffer(b, Suffixes.kind()) for b in blobs[0]])
        masks = repeated_windows(rows)
        hit = masks != 0
        out.append((rows["c1"][hit].astype(np.int64), rows["c2"][hit].astype(np.int64), masks[hit]))
    if 1 in blobs:
        rows = _distinct([np.frombuffer(b, WHOLE) for b in blobs[1]])
        rows = rows[rows["many"] > 0]
        out.append((rows["c1"].astype(np.int64), rows["c2"].astype(np.int64), np.ones(len(rows), np.int64)))
    return pa.table(dict(zip(("c1", "c2", "mask"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))


def unpacked(batches):
    """The places of each row, a batch for each; no group of them is ever held."""
    for batch in batches:
        for blob in batch.column("blob"):
            places = np.frombuffer(blob.as_buffer(), PLACE)
            yield pa.RecordBatch.from_arrays([pa.array(places[c].astype(np.int64)) for c in PLACE.names], names=list(PLACE.names))


# --- 4. removal --------------------------------------------------------------------------------
def _removal(batches):
    hasher = Hasher()
    for batch in batches:
        hits = batch.column("hits")
        for a, b, d, _, w in word_chunks(hasher, batch.column("text")):
            edge = np.zeros(len(w.hashes) + 1, np.int32)
            some = hits.slice(a, b - a)
            found = some.flatten()
            first = np.repeat(w.offsets[:-1], pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False))
            at, mask = first + found.field("at").to_numpy(zero_copy_only=False), found.field("mask").to_numpy(zero_copy_only=False)
            for back in range(WINDOW - ANCHOR + 1):
                begin = at[(mask >> back) & 1 == 1] - back
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + WINDOW, -1)
            gone = np.cumsum(edge[:-1]) > 0
            count = np.concatenate([[0], np.cumsum(gone)])[w.offsets]
            keep = ~gone
            sizes = (w.ends - w.starts)[keep] + 1
            flat = gather(np.append(d, np.uint8(32)), w.starts[keep], sizes)
            ends = np.cumsum(sizes)
            flat[ends - 1] = 32
            cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(keep)])[w.offsets]].tolist()
            raw = flat.tobytes()
            kept = [raw[x : max(x, y - 1)].decode("utf-8") for x, y in zip(cut[:-1], cut[1:], strict=True)]
            others = [batch.column(i).slice(a, b - a) for i, c in enumerate(batch.schema.names) if c not in ("hits",)]
            names = [c for c in batch.schema.names if c != "hits"]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(np.diff(w.offsets)), pa.array(np.diff(count)), pa.array(kept, pa.string()), pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept], pa.string())],
                names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, n_words, n_removed, kept_text, kept_sha256) of each row; kept_text: the kept words, one space between.

    ``carry``: other columns to return, as ``carry_0`` and so on.
    """
    spark = docs.sparkSession
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    extra = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    keyed = keyed.withColumns({"doc": F.coalesce("doc_id", F.lit(-1)), "sha": F.xxhash64("text")})
    total = part.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 16
    while blocks < 1 << 14 and total / 80 / blocks > 1_000_000:  # an anchor for some 80 bytes of text
        blocks *= 2
    counted = anchor_counts(part, blocks).collect()  # one row a block; the bitmap is 8 MB whatever the input
    bitmap = np.zeros((blocks, (1 << BITMAP_BITS) // 8 // blocks), np.uint8)
    for r in counted:
        bitmap[r.block] = np.frombuffer(r.bitmap, np.uint8)
    often = np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r.often, np.uint64) for r in counted)]))
    rows = sum(r.rows for r in counted)
    live, frequent = spark.sparkContext.broadcast(bitmap.tobytes()), spark.sparkContext.broadcast(often)
    groups = max(12, -(-rows // GROUP_ROWS))
    sent = staged(suffixes(keyed.select("doc", "sha", "text"), live, frequent, groups), "substring-sent")
    found = sent.filter("kind < 2").groupBy("block").applyInArrow(releasing(trees), "c1 long, c2 long, mask long")
    repeated = staged(found, "substring-found")
    # places are as many as the windows of hot passages: they are read batch by batch and not grouped
    places = sent.filter("kind = 2").select("blob").mapInArrow(releasing(unpacked), "c1 long, c2 long, doc long, sha long, at long")
    # a repeated row has the same places twice
    hits = places.join(repeated, ["c1", "c2"]).groupBy("doc", "sha").agg(F.collect_list(F.struct("at", "mask")).alias("hits"))
    # both sides grow with the corpus: texts and hits are dealt by document at every size
    joined = keyed.join(hits.hint("merge"), ["doc", "sha"], "left").drop("doc", "sha")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != "hits")
    return joined.mapInArrow(releasing(_removal), f"{kinds}, n_words long, n_removed long, kept_text string, kept_sha256 string")
