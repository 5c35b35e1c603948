"""The name join at size: what it makes, and how it joins."""
from lakeops.operators import entity, name_join
from lakeops.plans import crm_q


def test_names_that_are_there_are_not_compared(spark, monkeypatch):
    """A name that the other side has is its own best partner: nothing else is scored for it."""
    seen = []
    real = name_join._scored
    monkeypatch.setattr(name_join, "_scored", lambda pairs, left, right: seen.append(left.count()) or real(pairs, left, right))
    rows = spark.createDataFrame([(f"CUSTOMER {i:09}",) for i in range(50)] + [("CUSTOMER 00000004X",)], "name string")
    got = {r.lname: (r.rname, r.score) for r in name_join.best_similar(rows, rows.where("name not like '%X'"), 88.0).collect()}
    assert got["CUSTOMER 000000007"] == ("CUSTOMER 000000007", 100.0) and got["CUSTOMER 00000004X"][0] == "CUSTOMER 000000049"
    assert len(got) == 51 and seen and max(seen) == 1


def test_shortened_names_are_shuffled(spark, tmp_path):
    """A few names make many shortened ones: Spark must not collect them for a broadcast."""
    spark.createDataFrame([(f"CUSTOMER {i:09}",) for i in range(30)], "name string").write.parquet(str(tmp_path / "n"))
    names = name_join._names(spark.read.parquet(str(tmp_path / "n")))
    from pyspark.sql import functions as F

    pairs = name_join._deletion_pairs(names.withColumn("least", F.lit(88.0)), names, name_join.STEPS, ([18], [18]))
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_alert_detail_resolves_the_entities_once(spark, monkeypatch):
    calls = []
    real = entity.resolve_entities
    monkeypatch.setattr(entity, "resolve_entities", lambda *a, **k: calls.append(1) or real(*a, **k))
    crm_q.q_alert_detail(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1


def test_names_that_meet_nothing_are_not_shuffled(spark, monkeypatch):
    """Of many clients and few organisations, only shortened names and choices of grams that the other side may have are joined."""
    left = spark.createDataFrame([(f"CUSTOMER {i:09}",) for i in range(0, 60000, 7)], "name string")
    right = spark.createDataFrame([(f"CUSTMER {i:09}",) for i in range(0, 300, 7)] + [("CLIENT SIX 000042",)], "name string")
    plain = sorted(name_join.best_similar(left, right, 88.0).collect())
    kept = []
    real = name_join._seen_only

    def seen_only(rows, others):
        few = real(rows, others)
        met = rows.join(others.select("vh").distinct(), "vh", "left_semi").count()
        kept.append((met, few.count(), rows.count(), few._jdf.queryExecution().executedPlan().toString()))
        return few

    monkeypatch.setattr(name_join, "MANY_ROWS", 1000)
    monkeypatch.setattr(name_join, "_seen_only", seen_only)
    assert sorted(name_join.best_similar(left, right, 88.0).collect()) == plain and len(plain) > 40
    assert len(kept) >= 3
    for met, few, rows, plan in kept:
        assert met <= few <= met + rows // 20 and "BroadcastHashJoin" not in plan
    assert sum(k[1] for k in kept) < sum(k[2] for k in kept) / 2


def test_grams_are_ranked_name_by_name(spark, monkeypatch):
    """The rarest grams of a name are found in its own row: the grams of all names are not shuffled for it."""
    rows = spark.createDataFrame([(f"CUSTOMER {i:09}",) for i in range(40)] + [("NORTHERN PHARMA TRADE 12",)], "name string")
    names = name_join._names(rows)
    plan = name_join._part_pairs(names, names, 0.97)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    plans = []
    real = name_join.cut_lineage
    monkeypatch.setattr(name_join, "cut_lineage", lambda df: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or real(df))
    from pyspark.sql import functions as F

    left = real(names.withColumn("edits", F.lit(1)))
    pairs = name_join._gram_pairs(left, real(names)).collect()
    assert pairs
    ranked = [plan for columns, plan in plans if any(c.endswith("all") and c != "all" for c in columns)]
    assert len(ranked) == 2 and not any("hashpartitioning" in plan for plan in ranked)


def test_what_a_checkpoint_shuffled_goes_from_the_disk(spark):
    """A query of many steps must not keep the shuffle files of all of them."""
    import time

    from pyspark.sql import functions as F

    from lakeops.session import CLEAN_SHUFFLES, cut_lineage

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f and f.endswith(".data")}

    before, setting = shuffles(), spark.conf.get(CLEAN_SHUFFLES, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    got = cut_lineage(rows)
    for _ in range(100):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert sorted(got.collect()) == sorted(rows.collect()) and got.count() == 7
    assert spark.conf.get(CLEAN_SHUFFLES, None) == setting


def test_pairs_by_deletions_are_not_all_scored(spark, monkeypatch):
    """Of the names that are equally near by deletions one stands for all: their pairs are neither shuffled with the names nor scored one by one."""
    seen = []
    real = name_join._scored
    monkeypatch.setattr(name_join, "_scored", lambda pairs, left, right: seen.append(pairs.count()) or real(pairs, left, right))
    left = spark.createDataFrame([(f"CUSTOMER 0000000{i:02}",) for i in range(0, 20)], "name string")
    right = spark.createDataFrame([(f"CUSTOMER 0000001{i:02}",) for i in range(0, 20)] + [("CUSTMER 000000007",)], "name string")
    got = {r.lname: (r.rname, round(r.score, 6)) for r in name_join.best_similar(left, right, 88.0).collect()}
    assert len(got) == 20 and sum(seen) <= 20
    assert got["CUSTOMER 000000007"] == ("CUSTMER 000000007", round(3400 / 35, 6))
    # of the partners with 17 characters in common the last by name; 01 and 10 change places
    assert got["CUSTOMER 000000013"] == ("CUSTOMER 000000113", round(3400 / 36, 6))


def test_gram_counts_are_not_joined_to_the_names(spark):
    """A row of 65,536 counts beside each name is copied for each name."""
    rows = spark.createDataFrame([(f"CUSTOMER {i:09}",) for i in range(40)], "name string")
    names = name_join._names(rows)
    assert "Join" not in name_join._part_index(names).select("nid", name_join._gram_counts(name_join._slot, name_join._part_index(names)).alias("c"))._jdf.queryExecution().executedPlan().toString()
    plan = name_join._part_pairs(names, names, 0.97)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
