"""N-gram Jaccard self-join by a blocked sparse product of the document x shingle incidence.

Two documents link when their sets of distinct 5-word shingles have a Jaccard
likeness of num/den or more.  Documents with equal sets are one class; the product
runs over classes, so copies are never expanded into pairs.

1. One scan gives each document's set size and class, and shingles that are frequent
   within a task.  A bounded list of them sets an order: shingles not listed, listed ones, and ``hot`` ones (the
   most frequent); what the list lacks costs time, never a link.
2. A second scan takes from each set its prefix, ``n - ceil(t n) + 1`` shingles in that order and then by
   hash.  Linked sets share a shingle of their prefixes whatever the order.  Cold (not hot) prefix
   entries are dealt into blocks of the shingle space; each task multiplies its block (columns of the
   incidence with their transpose) and emits overlap counts of class pairs within the size bound.
3. The counts are summed over the blocks.  A pair is dropped if even all entries after the
   prefix that ends first could not lift it to the overlap ``ceil(t (a + b) / (1 + t))`` its sizes ask for.
4. Classes whose prefix reaches hot shingles (members of large near-copy groups, texts made of shared passages)
   are tied to one hub per hot shingle.  What stays unlinked to its hub is multiplied by the hot incidence against all
   classes of other components, in blocks of bounded size, with the same bound; a pair is taken only
   under the first hot shingle it shares.  Pairs within a component need no test: the result is the components.
5. Surviving pairs are tested on their whole sets, and the links give the components.

Shingles are told apart by 64-bit hashes, classes by the 64-bit sum of mixed hashes and their number.
Words are split at ASCII white space and A-Z is lower-cased.  A text of fewer than five words has
its whole sequence as one shingle; a text without words, or null, has none and links with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.components import connected_components
from lakeops.llm.staging import staged
from lakeops.llm.words import Hasher, mix, release_memory, releasing, shingle_sets, word_chunks

SHINGLE = 5
HOT_FROM = 64  # documents that have a shingle, as far as tasks saw it, from which on it is hot
MAX_LISTED = 1 << 19  # longest list of frequent shingles (5 MB sent to the tasks)
FLUSH = 500_000  # prefix entries that a task gathers before it writes blocks
HELD = 2_000_000  # shingles whose frequency a task counts at a time
BLOCK = 600_000  # expected prefix entries of a block
GROUP = 4096  # classes of one side of a hot block
GROUP_ENTRIES = 2_000_000  # hot shingles (8 bytes each) of the classes of one side of a hot block
TILE = 1024  # classes of one side that are multiplied at a time
SLICE = 4096  # columns of the hot incidence that are multiplied at a time
EXPLODED = 500_000  # narrow rows of a batch of hot shingles
BROADCAST_ROWS = 1_000_000  # document ids (8 bytes each) that may be sent to all tasks
END = np.uint64(2**64 - 1)


def class_of(s: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    return int((mix(s).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.int64)) if len(s) else 0


def needed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least overlap of linked sets of sizes a and b."""
    return -(-num * (a + b) // (num + den))


def size_ok(a, b, num: int, den: int):
    return den * np.minimum(a, b) >= num * np.maximum(a, b)


def prefix_length(n, num: int, den: int):
    return n - -(-num * n // den) + 1


def _sets(batches, k: int):
    """(batch, first row, sets of the rows) of each chunk."""
    hasher = Hasher(lower=True)
    for batch in batches:
        for a, b, _, _, w in word_chunks(hasher, batch.column("text")):
            yield batch, a, b, shingle_sets(hasher, w, k)


# --- 1. classes and frequent shingles ---------------------------------------------------
def classes(docs: DataFrame, k: int, measure=None, measures: tuple[str, ...] = ()) -> DataFrame:
    """Rows of kind 0: (doc_id, n, cls) and the carried columns; of kind 1: a shingle (cls) and the number of classes (n) of a task
    that have it, 2 at least.

    Carried are the columns of ``docs`` beside doc_id and text, and the ``measures`` (longs): measure(text column) gives an array of each.
    """
    carried = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]

    def frequent(held: list[np.ndarray]):
        s = np.sort(np.concatenate(held))
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        n = np.diff(np.append(at, len(s)))
        keep = n >= 2
        return s[at[keep]].astype(np.int64), n[keep]

    def rows(kind, ids, n, cls, more):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), ids, pa.array(n, pa.int64()), pa.array(cls, pa.int64()), *more],
                                          names=["kind", "doc_id", "n", "cls", *(f.name for f in carried), *measures])

    def scan(batches):
        held, size, seen, types, last, more = [], 0, set(), None, None, []

        def listed():
            s, n = frequent(held)
            return rows(1, pa.nulls(len(s), pa.int64()), n, s, [pa.nulls(len(s), t) for t in types])

        for batch, a, b, sets in _sets(batches, k):
            if batch is not last:
                last, more = batch, [*(batch.column(f.name) for f in carried), *(measure(batch.column("text")) if measure else ())]
                types = [c.type for c in more]
            names = [class_of(s) for s in sets]
            yield rows(0, batch.column("doc_id").slice(a, b - a), [len(s) for s in sets], names, [c.slice(a, b - a) for c in more])
            for c, s in zip(names, sets, strict=True):
                if len(s) and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            if size >= HELD:
                yield listed()
                held, size, seen = [], 0, set()
                release_memory()  # what counting them has needed, before the next batch
        if held:
            yield listed()

    more = [f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + [f"{m} long" for m in measures]
    return docs.mapInArrow(releasing(scan), ", ".join(["kind int, doc_id long, n long, cls long", *more]))


def frequent_shingles(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, whether each is hot): those with the highest counts, MAX_LISTED at most."""
    total = counts.groupBy("cls").agg(F.sum("n").alias("n"))
    by_count = total.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()
    least, room = 10_001, MAX_LISTED
    for r in sorted(by_count, key=lambda r: -r.n):
        if r.c > room:
            break
        least, room = r.n, room - r.c
    # if the top tier alone does not fit, its most frequent ones are taken
    top = total.filter(F.col("n") >= least) if least <= 10_000 else total.orderBy(F.desc("n"), "cls").limit(MAX_LISTED)
    got = top.toArrow()
    shingles, n = got.column("cls").to_numpy().astype(np.uint64), got.column("n").to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order] >= HOT_FROM


# --- 2. prefixes ---------------------------------------------------------------------------
class Blob:
    """Prefix entries of a block from one task: a table of classes, and (shingle, row of the table)."""

    FIELDS = (("cls", "<i8"), ("n", "<i8"), ("cold", "<i8"), ("end", "<u8"))

    @staticmethod
    def pack(table: list[np.ndarray], shingles: np.ndarray, rows: np.ndarray) -> bytes:
        head = np.array([len(table[0]), len(shingles)], "<i8")
        return b"".join([head.tobytes(), *(c.astype(t).tobytes() for c, (_, t) in zip(table, Blob.FIELDS, strict=True)),
                         shingles.astype("<u8").tobytes(), rows.astype("<u4").tobytes()])

    @staticmethod
    def unpack(raw: bytes):
        n, m = np.frombuffer(raw, "<i8", 2).tolist()
        table = [np.frombuffer(raw, t, n, 16 + 8 * n * i) for i, (_, t) in enumerate(Blob.FIELDS)]
        at = 16 + 32 * n
        return table, np.frombuffer(raw, "<u8", m, at), np.frombuffer(raw, "<u4", m, at + 8 * m)


PREFIX_SCHEMA = "block long, blob binary, cls long, n long, prefix long, cold long, hot binary"


def prefixes(docs: DataFrame, listed, n_blocks: int, num: int, den: int, k: int) -> DataFrame:
    """Blobs of cold prefix entries by block (0 and up); one row per class whose prefix reaches hot shingles (block under 0)."""
    names = ["block", "blob", "cls", "n", "prefix", "cold", "hot"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def scan(batches):
        frequent, hot_ones = listed.value
        table, entries, held, seen = [[], [], [], []], [], 0, set()

        def flush():
            nonlocal table, entries, held, seen
            t = [np.concatenate(c) for c in table]
            s, r = (np.concatenate(x) for x in zip(*entries, strict=True))
            order = np.argsort(s)
            s, r = s[order], r[order]
            cuts = np.searchsorted(((s >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32), np.arange(n_blocks + 1))
            blocks, blobs = [], []
            for i in range(n_blocks):
                a, b = cuts[i], cuts[i + 1]
                if b > a:
                    used, rows = np.unique(r[a:b], return_inverse=True)
                    blocks.append(i)
                    blobs.append(Blob.pack([c[used] for c in t], s[a:b], rows))
            table, entries, held, seen = [[], [], [], []], [], 0, set()
            none = [None] * len(blocks)
            return batch_of([blocks, blobs, none, none, none, none, none])

        for _, _, _, sets in _sets(batches, k):
            new = []
            for s in sets:
                c = class_of(s)
                if len(s) and c not in seen:
                    seen.add(c)
                    new.append((c, s))
            if not new:
                continue
            cls, n = np.array([c for c, _ in new], np.int64), np.array([len(s) for _, s in new])
            flat, owner = np.concatenate([s for _, s in new]), np.repeat(np.arange(len(n)), n)
            p = prefix_length(n, num, den)
            at = np.minimum(np.searchsorted(frequent, flat), max(len(frequent) - 1, 0))
            known = frequent[at] == flat if len(frequent) else np.zeros(len(flat), bool)
            is_hot = known & hot_ones[at] if len(frequent) else known
            first = np.cumsum(n) - n

            def place(mask):
                """Number of marked entries of the same set up to and with each entry."""
                c = np.cumsum(mask)
                return c - np.repeat(c[first] - mask[first], n)

            # the order: not listed, listed, hot
            nth = place(~known)
            unlisted = np.bincount(owner[~known], minlength=len(n))
            nth = np.where(known, place(known & ~is_hot) + unlisted[owner], nth)
            take = ~is_hot & (nth <= p[owner])
            cold = np.bincount(owner[take], minlength=len(n))
            end = np.full(len(n), END)
            last = take & (nth == p[owner])
            end[owner[last]] = (flat[last] >> np.uint64(1)) | (known[last].astype(np.uint64) << np.uint64(63))
            if take.any():
                entries.append((flat[take], owner[take] + sum(map(len, table[0]))))
            for c, v in zip(table, (cls, n, cold, end), strict=True):
                c.append(v)
            held += int(take.sum())
            short = np.flatnonzero(cold < p)
            if len(short):
                also = is_hot & (place(is_hot) <= (p - cold)[owner])
                # a class without a hot entry has its whole set in the prefix already
                short = short[np.bincount(owner[also], minlength=len(n))[short] > 0]
                tokens = [flat[first[i] : first[i] + n[i]][also[first[i] : first[i] + n[i]]].astype("<u8").tobytes() for i in short]
                if len(short):
                    yield batch_of([-1 - cls[short] % max(64, n_blocks), [None] * len(short), cls[short], n[short], p[short], cold[short], tokens])
            if held >= FLUSH:
                yield flush()
        if entries:
            yield flush()

    return docs.mapInArrow(releasing(scan), PREFIX_SCHEMA)


# --- 3. product of a block -------------------------------------------------------------------
PAIR_SCHEMA = "a long, b long, na long, nb long, shared long, least long, prefix long, cold long, hot binary"


def _run_pairs(bounds: np.ndarray, sizes: np.ndarray, limit: int = 4_000_000):
    """Index pairs (i < j) within runs, a bounded number at a time; one row of a very long run is never split."""
    for d in np.unique(sizes):
        starts = bounds[sizes == d]
        i, j = np.triu_indices(d, 1) if d <= 2048 else (None, None)
        if i is not None:
            step = max(1, limit // max(1, len(i)))
            for x in range(0, len(starts), step):
                s = starts[x : x + step, None]
                yield (s + i).ravel(), (s + j).ravel()
        else:
            for s in starts.tolist():
                for x in range(d - 1):
                    yield np.full(d - 1 - x, s + x), np.arange(s + x + 1, s + d)


def block_product(num: int, den: int):
    """Overlap counts of class pairs over the columns of a block; rows of hot classes pass through."""

    def product(t: pa.Table) -> pa.Table:
        kinds = [pa.int64()] * 8 + [pa.binary()]
        names = ["a", "b", "na", "nb", "shared", "least", "prefix", "cold", "hot"]
        if t.column("block")[0].as_py() < 0:
            once = t.group_by("cls").aggregate([(c, "min") for c in ("n", "prefix", "cold", "hot")])
            nulls = [pa.nulls(len(once), pa.int64())] * 4
            cols = [once["cls"], nulls[0], once["n_min"], *nulls[:3], once["prefix_min"], once["cold_min"], once["hot_min"]]
            return pa.table(dict(zip(names, cols, strict=True)), schema=pa.schema(list(zip(names, kinds, strict=True))))
        tables, shingles, rows, base = [], [], [], 0
        for raw in t.column("blob"):
            table, s, r = Blob.unpack(raw.as_py())
            tables.append(table)
            shingles.append(s)
            rows.append(r.astype(np.int64) + base)
            base += len(table[0])
        # one row per class, whichever tasks had copies of it
        cls, first, where = np.unique(np.concatenate([x[0] for x in tables]), return_index=True, return_inverse=True)
        n, cold, end = (np.concatenate([x[i] for x in tables])[first] for i in (1, 2, 3))
        s, r = np.concatenate(shingles), where[np.concatenate(rows)]
        order = np.argsort(s, kind="stable")
        s, r = s[order], r[order]
        same = s[1:] == s[:-1]
        shared = np.zeros(len(s), bool)
        shared[1:] |= same
        shared[:-1] |= same
        s, r = s[shared], r[shared]
        order = np.lexsort((r, s))
        s, r = s[order], r[order]
        if len(s):
            once = np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])])
            s, r = s[once], r[once]
        bounds = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(bounds, len(s)))
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in _run_pairs(bounds[sizes > 1], sizes[sizes > 1]):
            x, y = r[i], r[j]
            ok = size_ok(n[x], n[y], num, den)
            new, c = np.unique((x[ok] << 32) | y[ok], return_counts=True)
            merged, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            keys, counts = merged, np.bincount(at, np.concatenate([counts, c]), len(merged)).astype(np.int64)
        x, y = keys >> 32, keys & 0xFFFFFFFF
        rest_x, rest_y = n[x] - cold[x], n[y] - cold[y]
        rest = np.where(end[x] < end[y], rest_x, np.where(end[y] < end[x], rest_y, np.maximum(rest_x, rest_y)))
        least = needed(n[x], n[y], num, den) - rest
        cols = [cls[x], cls[y], n[x], n[y], counts, least]
        empty = [pa.nulls(len(keys), k) for k in kinds[6:]]
        return pa.table(dict(zip(names, [*(pa.array(c, pa.int64()) for c in cols), *empty], strict=True)))

    return product


# --- 4. hot shingles --------------------------------------------------------------------------
def _entries(blobs) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, row of each) of a column of blobs."""
    tokens = [np.frombuffer(x.as_py(), "<u8") for x in blobs]
    return np.concatenate([np.zeros(0, "<u8"), *tokens]), np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])


def _incidence(tokens, rows, n_rows: int, lo: int, hi: int) -> np.ndarray:
    """Dense incidence of the rows over the columns lo to hi; tokens are numbers of columns, in order."""
    a, b = np.searchsorted(tokens, [lo, hi])
    out = np.zeros((n_rows, hi - lo), np.float32)
    out[rows[a:b], tokens[a:b] - lo] = 1
    return out


def hot_product(num: int, den: int):
    """Pairs of classes of different components under their first shared hot shingle, within the bound."""

    def product(t: pa.Table) -> pa.Table:
        s = np.uint64(t.column("shingle")[0].as_py() % 2**64)
        cls, comp, n, p = (t.column(c).to_numpy() for c in ("cls", "comp", "n", "prefix"))
        left, right = t.column("left").to_numpy(zero_copy_only=False), t.column("right").to_numpy(zero_copy_only=False)
        flat, owner = _entries(t.column("hot"))
        vocab, flat = np.unique(flat, return_inverse=True)
        # entries in order of their column; the columns before s, and those from s on
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        before = int(np.searchsorted(vocab, s))
        li, ri = np.flatnonzero(left), np.flatnonzero(right)
        out = [np.zeros((0, 4), np.int64)]
        for x in range(0, len(li), TILE):
            for y in range(0, len(ri), TILE):
                l, r = li[x : x + TILE], ri[y : y + TILE]  # noqa: E741
                both = np.zeros((2, len(l), len(r)), np.float32)
                at_l, at_r = (np.full(len(cls), -1) for _ in range(2))
                at_l[l], at_r[r] = np.arange(len(l)), np.arange(len(r))
                in_l, in_r = at_l[owner] >= 0, at_r[owner] >= 0
                tl, ol, tr, o_r = flat[in_l], at_l[owner[in_l]], flat[in_r], at_r[owner[in_r]]
                for k, (lo, hi) in enumerate(((0, before), (before, len(vocab)))):
                    for c in range(lo, hi, SLICE):
                        d = min(hi, c + SLICE)
                        both[k] += _incidence(tl, ol, len(l), c, d) @ _incidence(tr, o_r, len(r), c, d).T
                earlier, shared = both
                na, nb = n[l][:, None], n[r][None, :]
                rest = np.maximum(na - p[l][:, None], nb - p[r][None, :])
                ok = (earlier == 0) & (comp[l][:, None] != comp[r][None, :]) & size_ok(na, nb, num, den) & (shared + rest >= needed(na, nb, num, den))
                i, j = np.nonzero(ok)
                i, j = l[i], r[j]
                out.append(np.stack([cls[i], cls[j], n[i], n[j]], axis=1))
        got = np.concatenate(out)
        return pa.table({c: pa.array(np.ascontiguousarray(got[:, i])) for i, c in enumerate(("a", "b", "na", "nb"))})

    return product


def hot_pairs(members: DataFrame, tokens: DataFrame, hubs: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b, na, nb) between components among classes that share a hot prefix shingle.

    members: a narrow row for each class and hot shingle; tokens: the hot shingles (hot) of each class, once.
    """
    known = members.join(labels.withColumnRenamed("vertex", "cls"), "cls", "left").withColumn("comp", F.coalesce("root", "cls")).drop("root")
    hub = hubs.join(labels.withColumnRenamed("vertex", "hub"), "hub", "left").select("shingle", F.coalesce("root", "hub").alias("hub_comp"))
    placed = known.join(hub, "shingle").withColumn("left", F.col("comp") != F.col("hub_comp"))
    n_tokens = F.col("prefix") - F.col("cold")  # at most so many
    sizes = (placed.groupBy("shingle").agg(F.sum(F.col("left").cast("long")).alias("n_left"), F.count(F.lit(1)).alias("n_all"),
                                           F.sum(F.when(F.col("left"), n_tokens).otherwise(0)).alias("t_left"), F.sum(n_tokens).alias("t_all")).filter("n_left > 0"))
    k = lambda n, t: F.greatest(F.ceil(F.col(n) / GROUP), F.ceil(F.col(t) / GROUP_ENTRIES)).cast("int")
    split = (placed.join(sizes, "shingle").withColumn("kl", k("n_left", "t_left")).withColumn("ka", k("n_all", "t_all"))
             .withColumn("i", F.pmod(F.xxhash64("cls"), F.col("kl")).cast("int")).withColumn("j", F.pmod(F.xxhash64("cls"), F.col("ka")).cast("int")))
    split = staged(split.select("shingle", "cls", "comp", "n", "prefix", "left", "kl", "ka", "i", "j"), "ngram-split")
    split = split.join(tokens, "cls")
    cols = ["shingle", "cls", "comp", "n", "prefix", "hot"]
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lefts = split.filter("left").select(*cols, "i", spread("ka").alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right"))
    rights = split.select(*cols, spread("kl").alias("i"), "j", F.lit(False).alias("left"), F.lit(True).alias("right"))
    found = lefts.union(rights).groupBy("shingle", "i", "j").applyInArrow(releasing(hot_product(num, den)), "a long, b long, na long, nb long")
    ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                           F.when(F.col("a") <= F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                           F.when(F.col("a") <= F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))
    return ordered.distinct()


# --- 5. test on whole sets -----------------------------------------------------------------------
def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """Links (u, v) among the candidate pairs, by the overlap of their whole sets.

    pairs: a, b and ``lead``, the one of them whose set is attached first.  A hub leads its pairs: its set meets all of
    them by their narrow rows, and the wide rows that come out are dealt by the other class, which few pairs share.
    Only one document of each class in a pair is read again; its set is written once.  A class of documents without an id
    is found by reading all of those again.
    """
    n_pairs = pairs.count()
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    named = staged(reps.join(wanted, "cls").select("cls", "doc_id"), "ngram-ids", 2 * n_pairs)
    n_ids, n_known = named.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    few = n_ids <= BROADCAST_ROWS
    ids = named.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    docs = docs.select("doc_id", "text")
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def sets_of(batches):
        for _, _, _, sets in _sets(batches, k):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["cls", "set"])

    found = texts.mapInArrow(releasing(sets_of), "cls long, set binary")
    if n_known < n_ids:
        unnamed = named.filter("doc_id IS NULL").select("cls")
        without = docs.filter("doc_id IS NULL").mapInArrow(releasing(sets_of), "cls long, set binary")
        found = found.union(without.join(F.broadcast(unnamed) if few else unnamed, "cls", "left_semi"))
    sets = staged(found.dropDuplicates(["cls"]), "ngram-sets", n_ids, 8192)

    def overlap(batches):
        for batch in batches:
            a, b, ok = batch.column("a"), batch.column("b"), []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok, pa.bool_())), b.filter(pa.array(ok, pa.bool_()))], names=["u", "v"])

    turned = pairs.select(F.col("lead").alias("a"), F.when(F.col("lead") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("b"))
    both = (turned.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("set").alias("sb")), "b"))
    return staged(both.select("a", "b", "sa", "sb").mapInArrow(releasing(overlap), "u long, v long"), "ngram-links", n_pairs, 16_384)


def linked_classes(part: DataFrame, *, num: int = 3, den: int = 4, shingle: int = SHINGLE, measure=None,
                   measures: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of documents (doc_id long, text, carried columns): (doc_id, n, cls, carried columns, measures) of each row; (cls, doc_id), one
    document of each class (a null id only where none has one); and (vertex, root), the component of each class that links with another.

    measure, measures: see ``classes``; they are taken in the scan that finds the classes.
    """
    spark = part.sparkSession
    scanned = staged(classes(part, shingle, measure, measures), "ngram-classes")
    rows = scanned.filter("kind = 0").drop("kind")
    part = part.select("doc_id", "text")
    listed = spark.sparkContext.broadcast(frequent_shingles(scanned.filter("kind = 1")))
    total = rows.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(12, -(-total * (den - num) // den // BLOCK))
    product = prefixes(part, listed, n_blocks, num, den, shingle).groupBy("block").applyInArrow(releasing(block_product(num, den)), PAIR_SCHEMA)
    counted = staged(product, "ngram-product")
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    cold = (counted.filter("b IS NOT NULL").select(*pair, "shared", "least").groupBy("a", "b")
            .agg(F.sum("shared").alias("shared"), F.max("least").alias("least")).filter("shared >= least").select("a", "b"))
    reps = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    tokens = staged(counted.filter("b IS NULL").select(F.col("a").alias("cls"), F.col("na").alias("n"), "prefix", "cold", "hot"), "ngram-tokens")
    members = staged(tokens.mapInArrow(releasing(_exploded), "cls long, n long, prefix long, cold long, shingle long"), "ngram-hot")
    # the hub of a shingle is the class with the least share of cold entries: the most central of a near-copy group
    hubs = members.groupBy("shingle").agg(F.min(F.struct((F.col("cold") / F.col("prefix")).alias("share"), F.col("cls").alias("hub"), F.col("n").alias("hub_n"))).alias("h")).select("shingle", "h.hub", "h.hub_n")
    star = (members.join(hubs, "shingle").filter("cls != hub")
            .filter(den * F.least("n", "hub_n") >= num * F.greatest("n", "hub_n"))
            .select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"), F.struct(F.lit(1).alias("star"), F.col("hub").alias("lead")).alias("l")))
    plain = cold.withColumn("l", F.struct(F.lit(0).alias("star"), F.col("a").alias("lead")))
    first = staged(plain.union(star).groupBy("a", "b").agg(F.max("l").alias("l")).select("a", "b", "l.lead"), "ngram-pairs")
    links = verified(first, part, reps, num, den, shingle)
    labels = connected_components(links)
    if not members.isEmpty():
        rest = staged(hot_pairs(members, tokens.select("cls", "hot"), hubs, labels, num, den).select("a", "b").join(first, ["a", "b"], "left_anti"), "ngram-rest")
        if not rest.isEmpty():
            more = verified(rest.withColumn("lead", F.col("a")), part, reps, num, den, shingle)
            labels = connected_components(links.union(more))
    return rows, reps, labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, num: int = 3, den: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row; component_id is the smallest doc_id reachable by links.

    Other columns of ``docs`` are not read.  Repeated rows are copies and share a component; rows of one id with
    different texts are documents of their own that share that id.  A document without an id links like any other: its
    component_id is the smallest id of its component, null if none there has one.
    """
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, reps, labels = linked_classes(part, num=num, den=den, shingle=shingle)
    named = reps.join(labels.withColumnRenamed("vertex", "cls"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
    least_id = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(least_id, "comp").select(F.col("cls"), "component_id")
    return (rows.join(by_class, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, num: int = 3, den: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: that of the lowest id (one without an id only if all are), then of the lowest text hash.

    Rows go by id and text, so another text of the same id stays, and rows without an id are told apart.  Of rows that
    repeat id and text one stays.  Texts without words link with nothing and all stay.
    """
    mark = F.xxhash64(F.col(text_col).cast("string"))
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), mark.alias("mark"))
    rows, _, labels = linked_classes(part, num=num, den=den, shingle=shingle)
    worded = rows.filter("n > 0").join(labels, F.col("cls") == F.col("vertex"), "left").withColumn("comp", F.coalesce("root", "cls"))
    # one row of counts per distinct (id, text): copies of a row meet before the shuffle
    marked = staged(worded.groupBy("comp", "doc_id", "mark").agg(F.count(F.lit(1)).alias("times")), "ngram-marked")
    first = marked.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")).select("comp", "first.*")
    own = F.col("m.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("m.mark") == F.col("f.mark"))
    named = marked.alias("m").join(first.alias("f"), "comp").select(F.col("m.doc_id").alias("d_id"), F.col("m.mark").alias("d_mark"), own.alias("stays"), "times")
    acted = staged(named.filter("NOT stays OR times > 1"), "ngram-acted")
    at = docs.withColumn("lakeops_mark", mark)

    def of(actions: DataFrame, how: str) -> DataFrame:
        # 16 bytes a row: sent to all tasks if they are few, so that texts stay where they are
        few = actions.count() <= BROADCAST_ROWS
        return at.join(F.broadcast(actions) if few else actions, at[id_col].cast("long").eqNullSafe(F.col("d_id")) & (at["lakeops_mark"] == F.col("d_mark")), how)

    kept = of(acted.select("d_id", "d_mark"), "left_anti")
    repeated = acted.filter("stays").select("d_id", "d_mark")
    if not repeated.isEmpty():
        kept = kept.union(of(repeated, "left_semi").dropDuplicates([id_col, "lakeops_mark"]))
    return kept.select(*docs.columns)


def _exploded(batches):
    """One narrow row per class and hot prefix shingle, in batches of a bounded size."""
    for batch in batches:
        names = [c for c in batch.schema.names if c != "hot"]
        narrow = batch.select(names)
        sizes = pc.binary_length(batch.column("hot")).to_numpy() // 8
        ends = np.cumsum(sizes)
        a = 0
        while a < len(ends):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + EXPLODED, "right")))
            flat, owner = _entries(batch.column("hot").slice(a, b - a))
            out = narrow.slice(a, b - a).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(flat.astype(np.int64))], names=[*names, "shingle"])
            a = b
