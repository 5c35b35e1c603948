"""Hard negatives, mixing and whitening against brute force."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm import hard_negatives, mixing, vectors, whitening
from lakeops.llm.queries import ORACLE, QUERIES
from lakeops.plans.compare import compare

from conftest import SF_SMALL
from llm_cases import documents, empty, words

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
# names that the operators use inside
CLASHING = ("anchor", "rank", "score", "block", "id", "mark", "label_", "n", "size", "component", "grp", "slice", "kind", "sums")


def vector_rows(seed=3, n=400, dim=6, common=120):
    """Random vectors; one that many rows share; the odd ones."""
    rng = np.random.default_rng(seed)
    got = [(i, [float(v) for v in rng.normal(0, 0.4, dim).astype(np.float32)], int(rng.integers(0, 4))) for i in range(n)]
    got += [(n + i, [0.25] * dim, i % 3) for i in range(common)]
    got += [(1000, None, 1), (1100, [0.5] * dim, None), (1200, [0.5, None] + [0.1] * (dim - 2), 1), (1201, [float("nan")] * dim, 2), (1300, [float("inf")] + [0.1] * (dim - 1), 2)]
    return got


def valid(data):
    return [(i, v, label) for i, v, label in data if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and i is not None]


def mined(data, every=50, scale=256):
    """The contract in plain Python; rows count one by one."""
    ok = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in valid(data)]
    width = max((len(v) for _, v, _ in ok), default=0)
    ok = [(i, v + [0] * (width - len(v)), label) for i, v, label in ok]
    out = []
    for at, (i, v, label) in enumerate(ok):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for k, (j, w, m) in enumerate(ok) if k != at]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted(x[:2] for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit, 1)]
    return sorted(out)


def mine(spark, data, every=50, **options):
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("extra"))
    got = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("dtype, low, high, dim", [(np.int16, -150, 150, 64), (np.int16, 3, 9, 1), (np.int64, -(2**20), 2**20, 7), (np.int64, -(2**28), 2**28, 3), (np.int64, 0, 1, 0), (np.int64, -(2**31), 2**31, 2), (np.int64, -5, -2, 4)])
def test_packed_products_are_exact(dtype, low, high, dim):
    rng = np.random.default_rng(7)
    a, c = rng.integers(low, high, (5, dim)).astype(dtype), rng.integers(low, high, (131, dim)).astype(dtype)
    want = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in c.tolist()] for r in a.tolist()]
    assert hard_negatives.PackedProducts(a).scores(c).tolist() == want


def test_a_score_beyond_a_long_is_an_error():
    big = np.full((1, 4), 2**62, np.int64)
    assert hard_negatives.PackedProducts(big[:, :1]).scores(np.ones((1, 1), np.int64)).tolist() == [[2**62]]
    with pytest.raises(OverflowError):
        hard_negatives.PackedProducts(big).scores(big)


def test_hard_negatives_equal_brute_force(spark):
    data = vector_rows()
    assert mine(spark, data) == mined(data) != []


def test_hard_negatives_do_not_hang_on_blocks_and_slices(spark, monkeypatch):
    data = vector_rows(seed=4)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "GROUP_ENTRIES", 24)
    monkeypatch.setattr(hard_negatives, "SLICE_ENTRIES", 600)
    monkeypatch.setattr(hard_negatives, "TILE", 7)
    assert mine(spark, data) == mined(data)


def test_hard_negatives_repeated_rows_short_vectors_and_null_ids(spark):
    data = vector_rows(n=120, common=30)
    data += data[:3] * 2 + [(50, [0.3, 0.2], 1), (None, [0.1] * 6, 1), (7, [], 2)]
    assert mine(spark, data) == mined(data)


@pytest.mark.parametrize("data", [[], [(100, [0.5, 0.5], 1)], [(100, [0.5], 1), (101, [0.5], 1)], [(100, None, 1)], [(100, [-1.0], 1), (1, [1.0], 1), (2, [0.0], 0)]])
def test_hard_negatives_of_few_rows(spark, data):
    assert mine(spark, data) == mined(data) == []


def test_hard_negatives_of_zero_scores(spark):
    """A positive of score 0 has negatives of score 0 only."""
    data = [(100, [0.0], 1), (101, [1.0], 1), (102, [1.0], 2), (103, [-1.0], 0)]
    assert mine(spark, data) == mined(data) == [(100, 101, 1, 102, 0, 0), (100, 101, 2, 103, 0, 0)]


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_source_mix"])
def test_registered_queries_equal_their_sql(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert r["ok"], r


# --- mixing --------------------------------------------------------------------------------------
def filled(sizes, weights, epochs=3):
    """Water-filling by bisection on the level: an independent way."""
    total, low, high = sum(sizes), 0.0, 1e18
    for _ in range(400):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(epochs * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < total else (low, mid)
    return [min(epochs * s, high * w) for s, w in zip(sizes, weights, strict=True)]


def check_mix(got, data, weights=(5, 2, 1), epochs=3):
    want = sorted((i, len(words(t))) for i, t, s in data if i is not None)
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == want and len(got) == len(data)
    names = sorted({s for *_, s in data if s is not None}, key=lambda s: s.encode()) + ([None] if any(s is None for *_, s in data) else [])
    sizes = [sum(len(words(t)) for _, t, s in data if s == name) for name in names]
    targets = filled(sizes, [weights[i % len(weights)] for i in range(len(names))], epochs)
    for name, size, target in zip(names, sizes, targets, strict=True):
        own = [r for r in got if r["source"] == name]
        assert {r["source_size"] for r in own} == {size}
        assert all(r["target"] == pytest.approx(target, rel=1e-9, abs=1e-6) for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= 0.5 + 1e-6
        whole = target // size if size else 0
        assert all(r["taken"] == r["whole"] * r["size"] + r["part"] and 0 <= r["part"] <= r["size"] and r["taken"] <= epochs * r["size"] for r in own)
        assert all(abs(r["whole"] - whole) <= (1 if abs(target - round(target)) < 0.5 else 0) for r in own)
        assert sum(0 < r["part"] < r["size"] for r in own) <= 1


def simple(data):
    return [(i, t, s) for i, t, _, s, _ in data]


def test_mixture_meets_its_targets(spark):
    df = documents(spark, clashing=True)
    got = mixing.mix(df).collect()
    check_mix(got, simple([tuple(r)[:5] for r in df.collect()]))
    assert sorted(map(str, mixing.mix(df.repartition(5)).collect())) == sorted(map(str, got))
    other = mixing.mix(df, seed=1).collect()
    assert sorted((r["doc_id"] or 0, r["taken"]) for r in other) != sorted((r["doc_id"] or 0, r["taken"]) for r in got)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 1000}, {"a": 1, "b": 2, "c": 1000, "d": 3, "é": 7, "Z": 500}, {"a": 0, "b": 5}, {"a": 0}, {None: 8, "": 3},
                                   {f"s{i:02}": 3**i % 101 for i in range(40)}])
def test_water_filling_clamps_and_shares_again(spark, sizes):
    rng = random.Random(2)
    data, i = [], 0
    for name, size in sizes.items():
        left = size
        while left or not any(s == name for *_, s in data):
            n = min(left, rng.randrange(0, 9))
            data.append((i, " ".join(["w"] * n) if n else None, name))
            left, i = left - n, i + 1
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    check_mix(mixing.mix(df).collect(), data)


def test_mixture_texts(spark):
    df = documents(spark)
    mixed = mixing.mix(df, carry=("text",))
    texts = mixing.repetitions(mixed).collect()
    assert sum(len(words(r["text"])) for r in texts) == mixed.agg(F.sum("taken")).first()[0]
    original = {(r["doc_id"], r["text"]) for r in df.collect()}
    assert sum((r["doc_id"], r["text"]) not in original for r in texts) <= 4  # one a source is cut


def test_mixture_of_nothing(spark):
    assert mixing.mix(empty(spark)).collect() == []


def test_mixture_runs_no_python(spark):
    plan = mixing.mix(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- whitening -----------------------------------------------------------------------------------
def whitened(spark, data, **options):
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("extra"))
    return whitening.whiten(df, **options).collect()


def check_whitened(got, data, components=32):
    ok = [(i, v) for i, v, _ in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in ok)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in ok], dtype=object)
    n, sums = len(ok), x.sum(axis=0)
    z = ((n * x - sums) / n).astype(float)
    values, vecs = np.linalg.eigh(z.T @ z / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    rank = min(components, int((values > 1e-10 * values[0]).sum()))
    assert len(got) == n * rank
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, rank + 1))
    exact = sorted((i if i is not None else -1, int(((n * r - sums) ** 2).sum())) for (i, _), r in zip(ok, x, strict=True))
    gaps = np.abs(values[:, None] - values[None, :]) + np.eye(len(values)) * 1e9
    for c, rows_ in by.items():
        assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]) for r in rows_) == exact
        assert {r["n"] for r in rows_} == {n} and len({r["identity_error"] for r in rows_}) == 1 and rows_[0]["identity_error"] < 1e-10
        assert rows_[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        if gaps[c - 1].min() > 1e-6 * values[0]:
            want = sorted(np.abs(z @ vecs[:, c - 1]) / math.sqrt(values[c - 1]))
            assert np.allclose(sorted(abs(r["whitened"]) for r in rows_), want, rtol=0, atol=1e-7)


def test_whitening_equals_an_eigendecomposition(spark):
    data = vector_rows(n=300, dim=40, common=30)
    check_whitened(whitened(spark, data), data)


def test_whitening_with_short_vectors_repeats_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    data = vector_rows(n=60, common=9)
    data += data[:4] * 3 + [(None, [0.1] * 6, 1), (70, [0.3, 0.2], 1), (71, [], None)]
    check_whitened(whitened(spark, data), data)


@pytest.mark.parametrize("data", [[], [(1, None, 1)], [(1, [0.5, 1.0], 1)], [(i, [0.5, 1.0], 1) for i in range(9)], [(1, [], 1), (2, [], 1)]])
def test_whitening_without_variance_gives_nothing(spark, data):
    assert whitened(spark, data) == []


def test_whitening_leaves_out_components_without_variance(spark):
    data = [(i, [float(i % 5), float(i % 3), 2.0, 2.0 * (i % 5)], 0) for i in range(60)]
    check_whitened(whitened(spark, data), data)


def test_eigenpairs_of_large_matrices_need_far_fewer_products_than_vectors():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((900, 400)) * np.linspace(1, 3, 400)
    v, calls = a.T @ a / 900, []
    values, vecs, residuals = whitening.eigenpairs(lambda u: calls.append(u.shape[1]) or v @ u, 400, 16)
    want, q = np.linalg.eigh(v)
    assert np.allclose(values, want[::-1][:16], rtol=1e-13, atol=0) and residuals.max() < 1e-12 * values[0]
    assert np.allclose(np.abs((vecs * q[:, ::-1][:, :16]).sum(axis=0)), 1, atol=1e-12) and len(calls) < 100


def test_eigenpairs_with_equal_values():
    v = np.diag([5.0, 5.0, 5.0, 2.0] + [0.0] * 40)
    values, vecs, _ = whitening.eigenpairs(lambda u: v @ u, 44, 4)
    assert np.allclose(values, [5, 5, 5, 2]) and np.allclose(vecs.T @ vecs, np.eye(4), atol=1e-14)


def test_whitening_query_over_its_table(spark):
    data = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()]
    check_whitened(QUERIES["op13_whitening"](spark, SF_SMALL).collect(), data)
