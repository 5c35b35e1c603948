"""Operators that judge each row: language ID, rules, importance, fingerprints, secrets."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_cases as C
from lakeops.llm import fingerprints, importance, langid, rules, secret_scan, stats

from conftest import SF_SMALL


def shingles(text):
    w = C.words(C.lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


# --- language ID ---------------------------------------------------------------------
def test_language_id_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.predict(docs.filter(langid.held_out(F.col("doc_id"))).drop("lang"), model).join(docs, "doc_id").toPandas()
    assert len(got) > 250 and (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all() and 0.05 < model.temperature < 20


def test_language_id_of_odd_rows(spark):
    docs = C.documents(spark, clashing=True)
    model = langid.fit(docs)
    assert model.langs == ["de", "en"]
    got = langid.predict(docs, model).filter("doc_id IS NOT NULL").toPandas().merge(docs.select("doc_id", "text").distinct().toPandas(), on="doc_id")
    for r in got.itertuples():
        without = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == without
        assert r.rejected if without else r.lang_pred in model.langs
    same = got[got.text == "one"]
    assert same.lang_pred.nunique() == 1 and same.score.nunique() == 1
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == (~langid.predict(docs, model).toPandas().rejected).sum()


def test_language_id_without_training_rows(spark):
    assert langid.fit(C.empty(spark)) is None
    assert langid.fit(C.documents(spark).filter("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.predict(C.documents(spark), None).collect()} == {"und"}
    assert langid.predict(C.empty(spark), None).count() == 0


def test_rejection_threshold_keeps_the_error_asked_for():
    model = langid.Model(["a", "b"], np.zeros((1 << langid.BUCKET_BITS, 2)), np.zeros(2))
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    margin = rng.normal(1.5, 1.5, 4000)
    logits = np.where((y == 0)[:, None], np.stack([margin, -margin], 1), np.stack([-margin, margin], 1))
    langid.calibrated(model, logits, y, 0.5, 0.01)
    p = model.scores(logits)
    sure = p.max(1) >= model.reject_below
    assert 0.5 < model.reject_below < 1 and (p.argmax(1) != y)[sure].mean() <= 0.01 < (p.argmax(1) != y).mean()


# --- statistics and rules ----------------------------------------------------------------
def slow_stats(text):
    text = text or ""
    w = C.words(text)
    lines = [x for x in text.split("\n") if C.words(x)]
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, cover = Counter(wins), set()
    for i, x in enumerate(wins):
        if count[x] > 1:
            cover |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def test_statistics_match_brute_force(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB \n\n\t\x0b\x1cé#|") for _ in range(rng.randrange(0, 60))) for _ in range(800)] + C.texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in stats.text_stats(docs).collect():
        assert tuple(r)[1:6] == slow_stats(texts[r.doc_id]), texts[r.doc_id]


def test_rules_find_planted_conditions():
    rng = np.random.default_rng(2)
    n = 6000
    x = {"a": rng.random(n), "b": rng.random(n), "noise": rng.random(n)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.5)) | (x["b"] > 0.95)
    learned = rules.learn(x, bad)
    hit = np.zeros(n, bool)
    for r in learned:
        hit |= r.mask(x)
    assert (hit == bad).mean() > 0.98 and learned and "noise" not in str(learned[0])


def test_rules_of_awkward_labels(spark):
    docs = C.documents(spark, clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(None, 1, 0), (3, None, 0), (4, 1, 0), (4, 0, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        got = rules.apply_rules(docs, rules.fit(docs, labels)).toPandas()
        assert len(got) == docs.count() and (got.kept == ~got.base_failed).all()
        want = (got.n_words < 10) | (100 * got.n_repeat_words > 20 * got.n_words)
        assert (got.base_failed == want).all()
    assert rules.apply_rules(C.empty(spark), []).count() == 0


def test_columns_and_masks_of_a_rule_agree(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learned = rules.fit(docs, labels)
    got = rules.apply_rules(docs, learned).toPandas()
    x = rules.features({c: got[c].to_numpy() for c in got.columns})
    first = np.zeros(len(got), int)
    for i in range(len(learned), 0, -1):
        first[learned[i - 1].mask(x)] = i
    assert (got.rule == first).all() and learned
    both = got.merge(labels.toPandas(), on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.95 and both[both.quality == 0].kept.mean() < 0.1


# --- importance resampling ----------------------------------------------------------------
def test_kth_largest_is_exact(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.gauss(0, 1), 0.25, 1e-9, -1e9]) for _ in range(900)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 2, 100, 450, 899, 900, 2000):
        assert importance.kth_largest(df, "v", k, bins=16) == ordered[min(k, len(ordered)) - 1]
    assert importance.kth_largest(df, "v", 0) is None and importance.kth_largest(df.filter("v > 1e12"), "v", 3) is None


def test_ratios_match_brute_force(spark):
    docs = C.documents(spark, clashing=True)
    good = spark.createDataFrame([(i,) for i in range(0, 40)], "doc_id long")
    from lakeops.llm.words import Hasher, word_chunks
    import pyarrow as pa

    raw, target = Counter(), Counter()
    for r in docs.collect():
        for *_, w in word_chunks(Hasher(lower=True), pa.array([r.text], pa.string())):
            b = importance.ngram_buckets(Hasher(lower=True), w, 16)[0].tolist()
            assert len(b) == max(0, 2 * len(C.words(r.text)) - 1)
            raw.update(b)
            if r.doc_id is not None and r.doc_id < 40:
                target.update(b)
    for salts in (1, 3):
        got = {}
        for r in importance.ngram_counts(docs, good, 16, salts).collect():
            got |= {r.part * 256 + a: (n, m) for a, n, m in importance.Counts.unpack(bytes(r.counts)).T.tolist()}
        assert got == {b: (n, target[b]) for b, n in raw.items()}


def test_models_grow_with_the_documents():
    assert [importance.bucket_bits(n) for n in (0, 1000, 200_000, 10**6, 10**12)] == [16, 16, 18, 20, 22]


def test_the_draw_matches_brute_force(spark):
    """Weights as sums over each document's n-grams, in plain Python; the k highest keys are drawn."""
    docs = C.documents(spark, repeated=False)
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(5, None), (None, 1)], "doc_id long, quality int")
    good = {i for i in range(90) if i % 3 == 0}

    from lakeops.llm.words import Hasher, word_chunks
    import pyarrow as pa

    bits = importance.bucket_bits(len(texts))
    buckets = {i: [int(x) for *_, w in word_chunks(Hasher(lower=True), pa.array([t], pa.string())) for x in importance.ngram_buckets(Hasher(lower=True), w, bits)[0]] for i, t in texts.items()}
    assert all(len(b) == max(0, 2 * len(C.words(texts[i])) - 1) for i, b in buckets.items())
    raw = Counter(x for b in buckets.values() for x in b)
    target = Counter(x for i, b in buckets.items() if i in good for x in b)
    n_raw, n_target = sum(raw.values()) + 2**bits, sum(target.values()) + 2**bits
    want = {i: sum(np.log((target[x] + 1) / n_target) - np.log((raw[x] + 1) / n_raw) for x in b) for i, b in buckets.items() if b}
    got = {r.doc_id: r for r in importance.resample(docs, labels, share=0.4).collect()}
    assert sorted(got) == sorted(texts) and all(got[i].log_weight is None for i in texts if i not in want)
    assert all(abs(got[i].log_weight - w) <= 1e-6 * (1 + abs(w)) for i, w in want.items())
    noise = {r.doc_id: r.g for r in docs.select("doc_id", importance.gumbel(F.col("doc_id"), 17).alias("g")).collect()}
    keys = sorted(((got[i].log_weight + noise[i], i) for i in want), reverse=True)
    assert {i for i, r in got.items() if r.selected} == {i for _, i in keys[: round(0.4 * len(texts))]}


def test_gumbel_keys_draw_in_proportion_to_the_weights(spark):
    """Of two documents of weights 3 and 1 the first has the higher key three times out of four."""
    df = spark.range(40_000).select((importance.gumbel(F.col("id"), 1) + F.log(F.lit(3.0)) > importance.gumbel(F.col("id"), 2)).cast("int").alias("won"))
    assert abs(df.agg(F.avg("won")).first()[0] - 0.75) < 0.01


@pytest.mark.parametrize("sf,n", [("sf0.01", 1000), ("sf0.1", 10_000)])
def test_resampling(spark, sf, n):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = importance.resample(docs, labels, share=0.5).toPandas()
    assert len(got) == n and got.selected.sum() == n // 2
    assert got[got.selected].key.min() >= got[~got.selected].key.max()
    both = importance.resample(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert both[both.quality == 1].selected.mean() > 0.95
    # sums favour short texts where the models are small: 16 of 58 bad ones are drawn at sf0.01
    assert both[both.quality == 0].selected.mean() < (0.2 if n > 1000 else 0.3)


def test_resampling_of_odd_rows(spark):
    docs = C.documents(spark, clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert not importance.resample(docs, none).filter("selected").count()
    got = importance.resample(docs, none, share=1.0).toPandas()
    assert len(got) == docs.count() and (got.selected == (got.n_ngrams > 0)).all()
    assert importance.resample(C.empty(spark), none, share=0.5).count() == 0


# --- fingerprints ------------------------------------------------------------------------
def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(3)
    pool = rng.permutation(np.unique(rng.integers(0, 2**64, 30_000, dtype=np.uint64)))
    a, b = np.sort(pool[:20_000]), np.sort(pool[5_000:25_000])
    x, y = fingerprints.sketch(a, 1024), fingerprints.sketch(b, 1024)
    assert abs(fingerprints.resemblance(x, y, 1024) - 0.6) < 0.07
    assert abs(fingerprints.containment(x, y, 1024) - 0.75) < 0.1
    assert abs(fingerprints.n_distinct(x, 1024) / 20_000 - 1) < 0.12
    halves = [fingerprints.sketch(np.sort(a[i::2]), 1024) for i in range(2)]
    assert (fingerprints.merge(*halves, 1024) == x).all()
    assert (fingerprints.from_text(fingerprints.to_text(x)) == x).all()
    none = fingerprints.sketch(a[:0])
    assert fingerprints.resemblance(none, none) == 1 and fingerprints.resemblance(none, x) == 0 and fingerprints.to_text(none) == ""


WIDE = [-(2**63), 2**63 - 1, 10**17, 0, -5, None]


@pytest.mark.parametrize("per_block", [1, 3, 8192])
def test_edit_report_of_any_ids(spark, per_block, monkeypatch):
    """Ids at both ends of the longs, far apart, null and repeated: the next row by (id, nulls first; text hash)."""
    whole = fingerprints.with_successors
    monkeypatch.setattr(fingerprints, "with_successors", lambda d: whole(d, per_block))
    data = [(i, f"text {k} of {n}") for n, i in enumerate(WIDE + [None, None, 7, 7, 7]) for k in range(2)] + [(i, f"row {i}") for i in range(100, 140)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = []
    for r, nxt in zip(rows, rows[1:] + rows[:1], strict=True):
        e = fingerprints.edited_text(r.text, nxt.text)
        want.append((str(r.doc_id), len(r.text), hashlib.sha256(e.encode()).hexdigest()))
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in fingerprints.edit_report(docs).collect())
    assert got == sorted(want)
    one = spark.createDataFrame([(9, "alone here")], "doc_id long, text string")
    assert [r.edited_sha256 for r in fingerprints.edit_report(one).collect()] == [hashlib.sha256(b"alonealone").hexdigest()]
    assert fingerprints.edit_report(one.limit(0)).count() == 0


def test_one_id_far_off_leaves_the_blocks_even(spark):
    docs = spark.range(4000).union(spark.createDataFrame([(10**17,)], "id long")).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    sizes = [r["count"] for r in fingerprints.with_successors(docs, 500).filter("ghost = 0").groupBy("block").count().collect()]
    assert len(sizes) == 9 and max(sizes) == 500


@pytest.mark.parametrize("per_block", [1, 16, 8192])
def test_edit_report_matches_brute_force(spark, per_block, monkeypatch):
    data = [r for r in C.rows()]
    random.Random(1).shuffle(data)
    docs = spark.createDataFrame(data, C.SCHEMA).selectExpr("doc_id * 3 - 50 AS doc_id", "text", "'x' AS near_next", "'y' AS block").repartition(4)
    whole = fingerprints.with_successors
    monkeypatch.setattr(fingerprints, "with_successors", lambda d: whole(d, per_block))
    got = {r.doc_id: r for r in fingerprints.edit_report(docs).collect()}
    order = sorted(docs.collect(), key=lambda r: r.doc_id)
    assert len(got) == len(order)
    for r, nxt in zip(order, order[1:] + order[:1], strict=True):
        t, n, g = r.text or "", nxt.text or "", got[r.doc_id]
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b, c = shingles(t), shingles(e), shingles(n)
        for near, other in ((g.near_edited, b), (g.near_next, c)):
            true = len(a & other) / len(a | other) if a | other else 1.0
            assert near == pytest.approx(true, abs=1e-9 if len(a | other) <= 128 else 0.25)


def test_edit_report_of_repeated_and_empty_tables(spark):
    docs = C.documents(spark)
    assert fingerprints.edit_report(docs).count() == docs.count()
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    r = fingerprints.edit_report(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()
    assert fingerprints.edit_report(C.empty(spark)).count() == 0


def test_merged_fingerprints_per_source(spark):
    docs = C.documents(spark, repeated=False)
    merged = {r.source: r for r in fingerprints.merge_by(fingerprints.fingerprint(docs).join(docs.select("doc_id", "source"), "doc_id"), "source").collect()}
    for source in ("src0", "src1", None):
        union = set()
        for r in docs.collect():
            if r.source == source:
                union |= shingles(r.text)
        assert abs(merged[source].n_shingles_est / len(union) - 1) < 0.35


# --- secrets -------------------------------------------------------------------------------
def slow_base(text):
    out = []
    for kind, pattern, ok in (("assign", re.compile(secret_scan.ASSIGN, re.I | re.A), lambda m: len(m[2]) >= 6),
                              ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)):
        out += [(m.start(), secret_scan.KINDS.index(kind), f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if ok(m)]
    return [s for *_, s in sorted(out)]


def test_base_spans_match_the_plain_patterns(spark):
    rng = random.Random(6)
    bits = ["password", "PASSWD", "token", "api_key", "apikey", "secret", "ſecret", "=", ":", " ", '"', "'", "abc", "deadbeef", "0123456789", "AKIA", "ABCDEF0123456789", "é", "🙂", "\n", "-._/+"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(3000)] + C.texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit("mine"))
    for r in secret_scan.find_secrets(docs).collect():
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "guess"]
        assert base == slow_base(texts[r.doc_id]), texts[r.doc_id]


def test_guess_cost_orders_values():
    cost = secret_scan.GuessCost().cost
    weak = ["password", "P@ssw0rd1", "qwertyuiop", "aaaaaaaaaaaa", "2024-01-15", "abcdefgh", "changeme123", "zaq12wsx"]
    strong = ["b7db7aa4a5fcc78305", "xK9#mQ2$vL7p", "Zx81kQp02Lm4"]
    assert max(map(cost, weak)) < 10 < min(map(cost, strong))
    assert cost("") == 0 and cost("password1999") < cost("passwqrd1q8z")


def test_guess_cost_is_the_cheapest_segmentation():
    g = secret_scan.GuessCost()

    def slow(v):
        char = np.log10(g._classes(v))
        found = {}
        for i, j, c in g._matches(v):
            found[i, j] = min(c, found.get((i, j), 99))
        best = [0.0]
        for j in range(1, len(v) + 1):
            best.append(min(best[i] + g_cost + secret_scan.SEGMENT_COST for i in range(j) for g_cost in ((j - i) * char, found.get((i, j), 1e9))))
        return best[-1]

    for v in ("hunter2", "P@ssw0rd99!", "qwerty1987abc", "aaabbbccc", "19991231x"):
        assert g.cost(v) == pytest.approx(slow(v))


def test_added_spans_and_redaction(spark):
    texts = {1: "pwd: hunter2xyz9Q! and client_id: changeme123", 2: "use bearer eyJhbGciOi5JIUzI1NiIs now", 3: "password=abcdef12 token: abc", 4: "the basic information is here", 5: None, 6: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in secret_scan.find_secrets(docs).collect()}
    assert spans == {1: [("guess", "hunter2xyz9Q")], 2: [("guess", "eyJhbGciOi5JIUzI1NiIs")], 3: [("assign", "password=abcdef12")], 4: [], 5: [], 6: []}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert clean == {1: "pwd: [guess]! and client_id: changeme123", 2: "use bearer [guess] now", 3: "[assign] token: abc", 4: texts[4], 5: None, 6: ""}
    assert secret_scan.find_secrets(C.empty(spark)).count() == 0
    assert secret_scan.redacted(C.documents(spark, clashing=True)).columns == C.documents(spark, clashing=True).columns


@pytest.mark.parametrize("before", ["Authorization: Bearer ", "bearer token: ", "secret token: ", "secret password: ", "credentials password: "])
def test_a_keyword_that_stands_as_a_value_gives_context(before):
    scan, value = secret_scan.Scanner(10.0), "$Kq9#zTr4L$x7Pw"
    assert scan(f"{before}{value} end") == [("guess", len(before), len(before) + len(value), scan.guess.cost(value))]


def test_values_are_judged_by_their_cost_alone():
    scan = secret_scan.Scanner(10.0)
    for text in ("pwd: Zq!vT#rW@kLpXs", "passphrase is kjhqwxzvbnrtw", "secret=ZqvTrWkLpXs;", "pwd zq!vt#rw@klpxs", "bearer ZqvTrWkLpXsMn"):
        value = re.split("[:=] ?| is | ", text)[1].rstrip(";")
        assert value not in secret_scan.masked(text, scan(text)), text
    for text in ("the basic information is here", "Basic Understanding of secret well-known (hidden)", "token: authorization", "password: changeme"):
        assert all(k != "guess" for k, *_ in scan(text)), text


def test_a_fixed_span_over_part_of_a_value_does_not_hide_the_rest():
    scan, text = secret_scan.Scanner(10.0), "set password=Tr0ub4dor&3xyz!Q9 and password=abcdef12"
    assert [(k, text[a:b]) for k, a, b, _ in scan(text)] == [("assign", "password=Tr0ub4dor"), ("guess", "Tr0ub4dor&3xyz!Q9"), ("assign", "password=abcdef12")]
    assert secret_scan.masked(text, scan(text)) == "set [assign] and [assign]"


def test_ordinary_words_are_no_secrets_with_a_vocabulary():
    import public_tokenizers

    words = secret_scan.vocabulary_words(public_tokenizers.path("word_bpe_49k.json"))
    assert words[: len(secret_scan.WORDS)] == secret_scan.WORDS and len(words) == len(set(words)) < 50_000
    scan, small = secret_scan.Scanner(10.0, words), secret_scan.Scanner(10.0)
    prose = ("the token is understandable to all", "password is complicated", "client id: documentation", "session id = transaction", "access key: responsibility")
    for text in prose:
        assert not scan(text) and [k for k, *_ in small(text)] == ["guess"], text
    for text in ("pwd: Zq!vT#rW@kLpXs", "passphrase is kjhqwxzvbnrtw", "bearer ZqvTrWkLpXsMn", "pwd: correcthorsebatterystaple", "pwd: hunter2xyz9Q"):
        assert [k for k, *_ in scan(text)] == ["guess"], text


def test_a_quoted_value_ends_with_its_quote():
    scan = secret_scan.Scanner(10.0)
    text = 'token = "ab8ca1b325bc4f85aa6a" and pwd = "Zq!vT#rW@kLpXs"### pwd: Zq"!vT#rW@kLpXs'
    assert [(k, text[a:b]) for k, a, b, _ in scan(text) if k == "guess"] == [("guess", "Zq!vT#rW@kLpXs"), ("guess", 'Zq"!vT#rW@kLpXs')]


def test_registered_queries_run(spark):
    from lakeops.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    for name in ("op1_language_id", "op4_secret_scan", "op10_quality_rules"):
        assert QUERIES[name](spark, SF_SMALL).count() == 200
