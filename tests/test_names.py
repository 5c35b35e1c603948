"""Name similarity against plain Python, and the similarity join against all pairs."""
import random

import pytest
from pyspark.sql import functions as F

from lakeops.functions import similarity as S
from lakeops.operators import entity, name_join


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a, b):
    a, b = sorted((a, b), key=len)
    m = len(a)
    return 100.0 if a == b == "" else max([ratio(a, b[i : i + m]) for i in range(len(b))] + [ratio(a, b[:i]) for i in range(1, m)] + [0.0]) if a else 0.0


def word_set(a, b):
    a, b = set(a.split()), set(b.split())
    if not a or not b:
        return 0.0
    shared, ra, rb = (" ".join(sorted(x)) for x in (a & b, a - b, b - a))
    if shared and (not ra or not rb):
        return 100.0
    full = lambda rest: f"{shared} {rest}" if shared else rest
    # the shared words stand in front, so whole texts may be compared
    gap = len(ra) + len(rb) - 2 * lcs(ra, rb)
    scores = [100 * (1 - gap / (len(full(ra)) + len(full(rb))))]
    return max(scores + ([ratio(shared, full(ra)), ratio(shared, full(rb))] if shared else []))


def weighted(a, b):
    if not a or not b:
        return 0.0
    in_order = lambda t: " ".join(sorted(t.split()))
    factor = max(len(a), len(b)) / min(len(a), len(b))
    if factor < 1.5:
        return max(ratio(a, b), 0.95 * ratio(in_order(a), in_order(b)), 0.95 * word_set(a, b))
    scale = 0.9 if factor <= 8 else 0.6
    once = lambda t: " ".join(sorted(set(t.split())))
    words = 100.0 if set(a.split()) & set(b.split()) else max(partial(in_order(a), in_order(b)), partial(once(a), once(b)))
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * words)


VOCAB = ["ACME", "LTDA", "SA", "COMERCIO", "DE", "PECAS", "SILVA", "MOTORES", "AUTO", "SUL", "IND", "E", "SERVICOS", "A"]


def names(seed, n):
    """Names of one to six words; copies with words moved, added, left out or repeated, and letters changed."""
    rng = random.Random(seed)

    def one():
        return " ".join(rng.choice(VOCAB) if rng.random() < 0.7 else "".join(rng.choice("ABCDEF") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 7)))

    def edited(name):
        w = name.split()
        rng.random() < 0.4 and rng.shuffle(w)
        w += [rng.choice(VOCAB)] * (rng.random() < 0.3) + w[:1] * (rng.random() < 0.2)
        if rng.random() < 0.2 and len(w) > 1:
            w.pop(rng.randrange(len(w)))
        s = list(" ".join(w))
        for _ in range(rng.randrange(0, 4)):
            s[rng.randrange(len(s))] = rng.choice("ABC ") if rng.random() < 0.5 else ""
        tail = " " + " ".join(rng.choice(VOCAB) for _ in range(6)) if rng.random() < 0.2 else ""
        return " ".join("".join(s).split()) + tail or "A"

    left = [one() for _ in range(n)]
    return left, [edited(x) for x in left]


def test_scores_equal_plain_python(spark):
    left, right = names(3, 60)
    pairs = list(zip(left, right, strict=True)) + list(zip(left, right[1:], strict=False))
    pairs += [("", ""), ("", "A"), ("A", "A"), ("ACME LTDA", "LTDA ACME SA"), ("a" * 70 + "b", "b" + "a" * 70), ("ÁÉ ÍÓ", "ÍÓ ÁÉ"), ("x" * 300, "x" * 30)]
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(pairs, "a string, b string").repartition(3)
    for got in df.select("a", "b", S.subsequence_ratio(a, b).alias("r"), S.word_set_ratio(a, b).alias("s"), S.partial_ratio(a, b).alias("p"), S.weighted_ratio(a, b).alias("w")).collect():
        want = (ratio(got.a, got.b), word_set(got.a, got.b), partial(got.a, got.b), weighted(got.a, got.b))
        assert (got.r, got.s, got.p, got.w) == pytest.approx(want), (got.a, got.b)


def test_known_scores(spark):
    """Values published for the weighted ratio and its parts."""
    df = spark.createDataFrame([("NEW YORK METS", "NEW YORK MEATS"), ("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear"), ("fuzzy was a bear", "fuzzy fuzzy was a bear")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = [tuple(round(x) for x in r) for r in df.select(S.subsequence_ratio(a, b), S.word_sort_ratio(a, b), S.word_set_ratio(a, b)).collect()]
    assert sorted(got) == sorted([(96, 96, 96), (91, 100, 100), (84, 84, 100)])


@pytest.mark.parametrize("threshold", [86.0, 93.0])
def test_the_join_loses_no_pair(spark, threshold):
    left, right = names(11, 90)
    left += ["X" * 40 + " LONG NAME", "AB", "B", "ACME LTDA"]
    right += ["X" * 39 + " LONG NAME", "AB CD EF GH", "ABB", "LTDA ACME SA", ""]
    want = {(a, b): weighted(a, b) for a in set(left) for b in set(right) if a and weighted(a, b) >= threshold - 1e-9}
    frames = [spark.createDataFrame([(x,) for x in side] + [(None,)], "name string").repartition(3) for side in (left, right)]
    got = {(r.lname, r.rname): r.score for r in name_join.similar_names(*frames, threshold).collect()}
    assert got == pytest.approx(want) and len(want) > 20
    best = {}
    for (a, b), s in want.items():
        best[a] = max(best.get(a, (0, 0, "")), (round(s, 9), -len(b), b))
    found = {r.lname: (round(r.score, 9), -len(r.rname), r.rname) for r in name_join.best_similar(*frames, threshold).collect()}
    assert found == best


def test_names_that_all_resemble_each_other(spark):
    """One word in all names, the rest differs in a few digits: the best partner is still the best."""
    left, right = [f"CUSTOMER {i:09}" for i in range(0, 400, 3)], [f"CUSTOMER {i:09}" for i in range(1000, 1400, 7)]
    frames = [spark.createDataFrame([(x,) for x in side], "name string") for side in (left, right)]
    got = {r.lname: (r.score, r.rname) for r in name_join.best_similar(*frames, 88.0).collect()}
    want = {a: max((weighted(a, b), b) for b in right) for a in left}
    assert got.keys() == want.keys() and all(got[a][0] == pytest.approx(want[a][0]) for a in want)


def test_low_thresholds_and_empty_sides(spark):
    one = spark.createDataFrame([("ACME",)], "name string")
    with pytest.raises(ValueError):
        name_join.similar_names(one, one, 85.0)
    assert name_join.similar_names(one.limit(0), one, 90.0).count() == name_join.best_similar(one, one.limit(0), 90.0).count() == 0


def test_subsequence_pairs_lose_none(spark):
    rng = random.Random(4)
    left, right = (["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 14))).strip() or "a" for _ in range(70)] for _ in range(2))
    rows = [(n, 69.5 if len(n) <= 6 else 79.5) for n in left]
    got = {tuple(r) for r in name_join.subsequence_pairs(spark.createDataFrame(rows, "name string, least double"), spark.createDataFrame([(n,) for n in right], "name string")).collect()}
    want = {(a, b) for a, least in rows for b in right if ratio(a, b) >= least}
    assert want and not want - got and len(got) < 0.7 * len(set(left)) * len(set(right))


def test_entities_match_in_any_order_of_words(spark):
    left = spark.createDataFrame([(1, "ACME COMERCIO LTDA", None), (2, "OUTRA EMPRESA QUALQUER", None)], "partner_code long, partner_name string, tax_id string")
    right = spark.createDataFrame([(7, "Ltda. Acme Comércio S/A", None)], "org_id long, org_name string, cnpj string")
    got = {r.partner_code: (r.org_id, r.match_type, r.match_score) for r in entity.resolve_entities(left, right).collect()}
    assert got == {1: (7, "name_fuzzy", 95.0), 2: (None, "unmatched", None)}
