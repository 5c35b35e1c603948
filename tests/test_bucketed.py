"""The copy-on-write table in buckets: what a batch rewrites, replays, late rows, whole versions, two writers."""
import datetime as dt
import os
import random
import tempfile

import pytest

from lakeops.streaming import bucketed as B
from lakeops.streaming import upsert as U

SCHEMA = "k long, name string, t timestamp_ntz, x int"


def _df(spark, rows):
    return spark.createDataFrame([(k, n, dt.datetime(2024, 1, 1) + dt.timedelta(hours=t), x) for k, n, t, x in rows], SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def _table(spark, n=400, n_buckets=16):
    root = f"{tempfile.mkdtemp(prefix='lakeops-bucketed-')}/t"
    df = _df(spark, [(i, f"n{i}", 0, i) for i in range(n)])
    B.overwrite(df, root, ["k"], ["t"], n_buckets)
    return root, df


def test_one_key_rewrites_one_bucket(spark):
    root, df = _table(spark)
    before = _files(root)
    assert len(before) == 16  # a file a bucket
    old = B.manifest(spark, root)
    B.merge(_df(spark, [(7, "new", 1, -1)]), root, ["k"], ["t"], df.schema)
    new = B.manifest(spark, root)
    assert len(_files(root) - before) == 1 and before < _files(root)
    same = {(w, b) for w, bs in old["writes"].items() for b in bs} & {(w, b) for w, bs in new["writes"].items() for b in bs}
    assert len(same) == 15
    got = {r.k: (r.name, r.x) for r in B.read(spark, root, df.schema).collect()}
    assert len(got) == 400 and got[7] == ("new", -1) and got[8] == ("n8", 8)
    assert _rows(B.read(spark, root, df.schema, "v=000000000000")) == _rows(df)  # the version before is whole


def test_key_reads_prune_buckets(spark):
    root, df = _table(spark)
    got = B.read_keys(spark, root, df.schema, spark.createDataFrame([(7,), (7,), (9999,), (None,)], "k int"))
    assert [r.name for r in got.collect()] == ["n7"]
    assert len(got.inputFiles()) <= 3
    assert B.read_keys(spark, f"{root}-none", df.schema, df.select("k")).count() == 0


def test_replay_and_empty_batches(spark):
    root, df = _table(spark)
    delta = _df(spark, [(1, "a", 2, 1), (1, "b", 3, 2), (1000, "c", 1, 3), (None, "d", 1, 4), (None, None, 0, None)])
    B.merge(delta, root, ["k"], ["t"], df.schema)
    once = _rows(B.read(spark, root, df.schema))
    assert len(once) == 402 and sum(r[0] is None for r in once) == 1
    B.merge(delta, root, ["k"], ["t"], df.schema)
    assert _rows(B.read(spark, root, df.schema)) == once
    n = len(B.versions(spark, root))
    assert B.merge(delta.limit(0), root, ["k"], ["t"], df.schema) is None and len(B.versions(spark, root)) == n
    assert os.listdir(f"{root}/_delta") in ([], [".crc"])
    empty = f"{root}-empty"
    B.overwrite(df.limit(0), empty, ["k"], ["t"])
    assert B.read(spark, empty, df.schema).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_any_order_give_the_same_table(spark, seed):
    """Deltas out of order over three batches end as one batch does; without ``newest`` the last batch stays."""
    rnd = random.Random(seed)
    rows = [(rnd.randrange(20), f"s{i}", t, i) for i, t in enumerate(rnd.sample(range(1000), 90))]
    df = _df(spark, rows)
    base = tempfile.mkdtemp(prefix="lakeops-late-")
    args = dict(keys=["k"], order_by=["t"], schema=df.schema, n_buckets=4)
    for i in range(3):
        U.upsert_batch(_df(spark, rows[i::3]), i, root=f"{base}/three", run_id="r", **args)
    U.upsert_batch(df, 0, root=f"{base}/one", run_id="r", **args)
    three = _rows(U.read_target(spark, f"{base}/three", df.schema))
    assert three == _rows(U.read_target(spark, f"{base}/one", df.schema))
    best = {}
    for k, n, t, x in rows:
        best[k] = max(best.get(k, (-1,)), (t, n, x))
    assert {(r[0], r[1], r[3]) for r in three} == {(k, n, x) for k, (t, n, x) in best.items()}
    U.upsert_batch(_df(spark, [(rows[0][0], "late", -5, 0)]), 9, root=f"{base}/one", run_id="r", newest=False, **args)
    assert [r[1] for r in _rows(U.read_target(spark, f"{base}/one", df.schema)) if r[0] == rows[0][0]] == ["late"]


def test_overtaken_writer_merges_again(spark, monkeypatch):
    """Another writer commits while a merge runs: both deltas are in the table, and no name is given twice."""
    root, df = _table(spark, 50, 4)
    commit, other = B._commit, []

    def late(spark_, root_, number, content):
        if not other:
            other.append(True)
            B.merge(_df(spark, [(2, "other", 1, 0)]), root, ["k"], ["t"], df.schema)
        return commit(spark_, root_, number, content)

    monkeypatch.setattr(B, "_commit", late)
    B.merge(_df(spark, [(2, "mine", 2, 0), (3, "mine", 2, 0)]), root, ["k"], ["t"], df.schema)
    got = {r.k: r.name for r in B.read(spark, root, df.schema).collect()}
    assert got[2] == got[3] == "mine" and len(got) == 50
    assert B.versions(spark, root) == [f"v={i:012d}" for i in range(3)]
    with pytest.raises(B.VersionTaken):
        commit(spark, root, 1, B.manifest(spark, root))


def test_failed_write_leaves_the_table(spark, monkeypatch):
    root, df = _table(spark, 50, 4)
    before = _rows(B.read(spark, root, df.schema))

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(B, "_commit", fail)
    with pytest.raises(OSError):
        B.merge(_df(spark, [(2, "x", 1, 0)]), root, ["k"], ["t"], df.schema)
    assert _rows(B.read(spark, root, df.schema)) == before and len(B.versions(spark, root)) == 1


def test_old_versions_go_with_their_files(spark):
    root, df = _table(spark, 50, 4)
    for i in range(3):
        B.merge(_df(spark, [(2, f"x{i}", i + 1, 0)]), root, ["k"], ["t"], df.schema)
    rows = _rows(B.read(spark, root, df.schema))
    B.drop_old(spark, root, 1)
    assert B.versions(spark, root) == ["v=000000000003"] and _rows(B.read(spark, root, df.schema)) == rows
    assert len(_files(root)) == 4


def test_other_keys_and_taken_names_are_refused(spark):
    root, df = _table(spark, 10, 4)
    with pytest.raises(ValueError):
        B.merge(df, root, ["name"], ["t"], df.schema)
    bad = df.withColumnRenamed("name", "_bucket")
    with pytest.raises(ValueError):
        B.merge(bad, root, ["k"], ["t"], bad.schema)
