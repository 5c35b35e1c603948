"""N-gram join, substring dedup, components and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
import llm_cases as C
from lakeops.llm import langid, ngram_join, secret_scan, substring_dedup
from lakeops.llm.components import connected_components
from lakeops.llm.words import Hasher, word_chunks


def shingles(text):
    w = C.words(C.lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def slow_components(rows):
    """{row: smallest id reachable} over (id, text) rows, all pairs that share a shingle tested."""
    sets = [shingles(t) for _, t in rows]
    have, tied = defaultdict(list), Union()
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in have[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                tied.tie(i, j)
        for g in s:
            have[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = tied.find(i)
        least[r] = d if least.get(r) is None else min(least[r], d if d is not None else least[r])
    return [(d, len(s), least[tied.find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def slow_removal(texts, window=35):
    seen = Counter()
    split = [C.words(t) for t in texts]
    for w in split:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        yield len(w), sum(gone), kept


def crowd(seed=9):
    """A large group of near copies, texts made of shared passages, and chains of copies of copies."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocab) for _ in range(90)]
    passages = [" ".join(rng.choice(vocab) for _ in range(50)) for _ in range(3)]
    out = [" ".join(base)]
    for _ in range(120):
        w = base[:]
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append(" ".join(w))
    for _ in range(150):
        out.append(" ".join([*rng.sample(passages, rng.randrange(1, 3)), *(rng.choice(vocab) for _ in range(rng.randrange(0, 25)))]))
    chain = base[:]
    for _ in range(30):
        chain = chain[:]
        chain[rng.randrange(len(chain))] = rng.choice(vocab)
        out.append(" ".join(chain))
    for _ in range(60):
        out.append(" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 80))))
    out += out[3:9] + ["a b " * 200, "a b " * 150 + "c d e f g", "a b " * 150]
    rng.shuffle(out)
    return out


def test_components_of_a_graph(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(900, i) for i in range(901, 990)] + [(5, 5)]
    tied = Union()
    for a, b in edges:
        tied.tie(a, b)
    got = {r.vertex: r.root for r in connected_components(spark.createDataFrame(edges + [(None, 3)], "u long, v long")).collect()}
    want = {v: tied.find(v) for a, b in edges if a != b for v in (a, b)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("hot_from,group", [(64, 4096), (8, 4096), (8, 16), (3, 50)])
def test_jaccard_components_of_crowded_groups(spark, monkeypatch, hot_from, group):
    monkeypatch.setattr(ngram_join, "HOT_FROM", hot_from)
    monkeypatch.setattr(ngram_join, "GROUP", group)
    rows = list(enumerate(crowd()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(docs).collect())
    assert got == sorted(slow_components(rows))


def test_hot_shingles_are_exploded_without_their_sets(monkeypatch):
    """200 classes of 2,500 hot shingles: narrow rows in small batches, where whole sets in each row take 10 GB."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "EXPLODED", 100_000)
    one = np.arange(2500, dtype="<u8").tobytes()
    whole = pa.RecordBatch.from_pydict({"cls": list(range(200)), "n": [9] * 200, "prefix": [2500] * 200, "cold": [0] * 200, "hot": pa.array([one] * 200, pa.binary())})
    got = list(ngram_join._exploded([whole]))
    assert {tuple(b.schema.names) for b in got} == {("cls", "n", "prefix", "cold", "shingle")}
    assert sum(map(len, got)) == 200 * 2500 and max(map(len, got)) <= 100_000 and max(b.nbytes for b in got) <= 40 * 100_000


@pytest.mark.parametrize("tile,cut,entries", [(7, 5, 2_000_000), (1024, 4096, 40)])
def test_hot_blocks_in_slices_match_brute_force(spark, monkeypatch, tile, cut, entries):
    for name, value in (("HOT_FROM", 3), ("TILE", tile), ("SLICE", cut), ("GROUP_ENTRIES", entries)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = list(enumerate(crowd(11)))
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(slow_components(rows))


def test_jaccard_components_of_odd_rows(spark):
    docs = C.documents(spark, clashing=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(docs).collect()), key=key)
    assert got == sorted(slow_components(rows), key=key)
    assert ngram_join.jaccard_components(C.empty(spark)).count() == 0


A60 = " ".join(f"w{i}" for i in range(60))
B60 = " ".join(f"v{i}" for i in range(60))


@pytest.mark.parametrize("ids,want", [((1, None), [(1, 1), (None, 1)]), ((None, None), [(None, None), (None, None)]), ((None, 8), [(8, 8), (None, 8)])])
def test_documents_without_an_id_link(spark, ids, want):
    rows = [(ids[0], A60), (ids[1], A60 + " more"), (5, B60), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.jaccard_components(docs).collect()), key=key)
    assert got == sorted([*want, (5, 5), (None, None), (None, None)], key=key)


def test_removal_of_near_copies_goes_by_id_and_text(spark):
    """Another text of a removed id stays, rows without an id are told apart, repeated rows stay once, texts without words stay."""
    rows = [(1, A60), (2, A60 + " more"), (2, B60), (2, B60), (None, A60 + " other"), (None, "a text of its own that has no copy at all"), (3, ""), (3, ""), (4, None), (None, B60 + " x")]
    docs = spark.createDataFrame([(i, t, f"s{n}") for n, (i, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    got = ngram_join.without_near_duplicates(docs)
    assert got.columns == docs.columns
    want = [(1, A60), (2, B60), (None, rows[5][1]), (3, ""), (3, ""), (4, None)]
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(t)) for i, t in want)
    nulls = spark.createDataFrame([(None, A60), (None, A60), (None, A60 + " more")], "doc_id long, text string")
    assert ngram_join.without_near_duplicates(nulls).count() == 1
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 6


def test_prefixes_at_the_bound():
    """Every linked pair shares a prefix shingle under any order, and the bound does not drop it."""
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(1, 60)
        a = rng.sample(range(1000), n)
        b = a[rng.randrange(0, n // 4 + 1) :] + rng.sample(range(1000, 2000), rng.randrange(0, n // 4 + 1))
        both, a, b = len(set(a) & set(b)), sorted(a), sorted(b)
        linked = 4 * both >= 3 * (len(a) + len(b) - both)
        pa_, pb = (int(ngram_join.prefix_length(len(x), 3, 4)) for x in (a, b))
        shared = len(set(a[:pa_]) & set(b[:pb]))
        x, p = (a, pa_) if a[pa_ - 1] <= b[pb - 1] else (b, pb)
        passes = shared > 0 and shared + len(x) - p >= ngram_join.needed(len(a), len(b), 3, 4)
        assert passes or not linked


@pytest.mark.parametrize("frequent,flush", [(20_000, 60_000), (3, 60_000), (3, 200), (40, 50)])
def test_removal_matches_brute_force(spark, monkeypatch, frequent, flush):
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(substring_dedup, "FLUSH_ROWS", flush)
    texts = crowd(3) + C.texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs).collect()}
    for i, want in enumerate(slow_removal(texts)):
        assert got[i] == want, texts[i]


def test_the_list_of_frequent_shingles_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MAX_LISTED", 5)
    counts = spark.createDataFrame([(i, 20_000 + i) for i in range(20)] + [(50, 70)], "cls long, n long")
    shingles, hot = ngram_join.frequent_shingles(counts)
    assert shingles.tolist() == [15, 16, 17, 18, 19] and hot.all()
    same = ngram_join.frequent_shingles(counts.selectExpr("cls", "70L AS n"))[0]
    assert same.tolist() == [0, 1, 2, 3, 4]
    few, hot = ngram_join.frequent_shingles(counts.filter("cls < 2 OR cls = 50"))
    assert few.tolist() == [0, 1, 50] and hot.all()
    assert not len(ngram_join.frequent_shingles(counts.filter("false"))[0])


def test_places_are_read_in_batches_and_not_grouped(spark, monkeypatch):
    """A passage in every document: no group holds places, and no row has more than PLACES of them."""
    monkeypatch.setattr(substring_dedup, "PLACES", 50)
    monkeypatch.setattr(substring_dedup, "FREQUENT", 20)
    whole, sent = substring_dedup.staged, {}
    monkeypatch.setattr(substring_dedup, "staged", lambda df, name, *a: sent.setdefault(name, whole(df, name, *a)))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} own{i}" for i in range(200)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted((r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == sorted(slow_removal(texts))
    sizes = [len(r.blob) // substring_dedup.PLACE.itemsize for r in sent["substring-sent"].filter("kind = 2").collect()]
    assert max(sizes) <= 50 and sum(sizes) >= 200 * 26
    assert sent["substring-found"].columns == ["c1", "c2", "mask"]


def test_removal_of_odd_rows(spark):
    docs = C.documents(spark, clashing=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs).collect()), key=str)
    want = [(d, n, m, hashlib.sha256(k.encode()).hexdigest()) for (d, _), (n, m, k) in zip(rows, slow_removal([t for _, t in rows]), strict=True)]
    assert got == sorted(want, key=str)
    assert substring_dedup.remove_repeats(C.empty(spark)).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(80)]
    texts = [" ".join([*(f"x{rng.randrange(500)}" for _ in range(rng.randrange(0, 50))), *passage, *(f"x{rng.randrange(500)}" for _ in range(20))]) for _ in range(20)]
    hasher, found = Hasher(), defaultdict(set)
    import pyarrow as pa

    for *_, w in word_chunks(hasher, pa.array(texts)):
        an = substring_dedup.Anchors(hasher, w)
        for at, near, far, doc in zip(an.at, an.near, an.far, an.doc, strict=True):
            for d in range(near, far + 1):
                words = tuple(texts[doc].split()[at - w.offsets[doc] - d :][: substring_dedup.WINDOW])
                found[words].add((d, int(an.keys[list(an.at).index(at)])))
    assert all(len(v) == 1 for v in found.values()) and sum(map(len, found.values())) > 500


# --- pipeline ---------------------------------------------------------------------------------
def test_pipeline_stages_follow_brute_force(spark):
    docs = C.documents(spark).filter("doc_id IS NOT NULL").dropDuplicates()
    cols = docs.columns
    model = langid.fit(docs)
    now = {r.doc_id: r for r in docs.collect()}
    ids = {r.doc_id for r in langid.predict(docs, model).filter("NOT rejected").collect()}
    stage = dict(corpus_pipeline.STAGES)

    out = stage["language_id"](spark, docs, "")
    assert out.columns == cols and {r.doc_id for r in out.collect()} == ids

    rows = [(i, now[i].text) for i in sorted(ids)]
    keep = {d for d, _, c in slow_components(rows) if d == c}
    out = stage["ngram_join"](spark, out, "")
    assert out.columns == cols and sorted(r.doc_id for r in out.collect()) == sorted(keep)

    rows = [(i, t) for i, t in rows if i in keep]
    text = {}
    for (i, t), (n, m, k) in zip(rows, slow_removal([t for _, t in rows]), strict=True):
        if m < n or n == 0:
            text[i] = k if m else t
    out = stage["substring_dedup"](spark, out, "")
    assert out.columns == cols and {r.doc_id: r.text for r in out.collect()} == text
    assert out.schema.simpleString() == docs.schema.simpleString()

    scan = secret_scan.Scanner(10.0)
    text = {i: secret_scan.masked(t, scan(t)) for i, t in text.items()}
    out = stage["secret_scan"](spark, out, "")
    assert out.columns == cols and {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (t, len(t)) for i, t in text.items()}

    out = stage["best_fit_packing"](spark, out, "")
    assert {r.doc_id for r in out.collect()} == set(text)


def test_pipeline_takes_repeated_and_empty_tables(spark):
    docs = C.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, C.empty(spark), "").count() == 0, name
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    groups = ngram_join.jaccard_components(docs.filter("doc_id IS NOT NULL"))
    assert kept.filter("doc_id IS NOT NULL").count() == groups.select("component_id").distinct().count()
    assert corpus_pipeline.best_fit_packing(spark, C.empty(spark), "").count() == 0


def test_pipeline_runs_on_a_table_with_extra_columns(spark, tmp_path):
    docs = C.documents(spark, clashing=True).filter("text IS NOT NULL")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(got) and got.groupby("bin").n_tokens.sum().max() <= 2048
    assert not np.isnan(got.bin).any()
