"""Prefix sums, window states and sketch states against plain Python and the direct forms."""

import datetime
import random
from collections import Counter
from decimal import Decimal as D

import numpy as np
from pyspark.sql import functions as F

from lakeops.operators import commercial as com
from lakeops.operators import partials
from lakeops.operators import projection as PJ
from lakeops.operators import targets


def test_running_totals_over_many_ranges_with_ties_and_nulls(spark):
    rng = random.Random(4)
    # one value of the order holds a third of the rows; every fifth amount is null, the first ones among them
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(100), None if i % 5 == 0 else D(rng.randrange(-500, 10_000)) / 100) for i in range(6000)]
    df = spark.createDataFrame(rows, "i int, k int, v decimal(18,2)").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = PJ.running_totals(df, "v", ["k"], overall="whole").orderBy("position").collect()
        assert PJ.running_totals(df, "v", [F.col("k").desc(), "i"]).filter("position = 1").first().k == 99
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.position for r in got] == list(range(1, 6001)) and sorted(r.i for r in got) == list(range(6000))
    assert [r.k for r in got] == sorted(k for _, k, _ in rows)
    total, whole = None, sum(v for *_, v in rows if v is not None)
    for r in got:
        total = total if r.v is None else (total or 0) + r.v
        assert r.running == total and r.whole == whole


def test_running_totals_without_rows_or_values(spark):
    empty = spark.createDataFrame([], "k int, v decimal(18,2)")
    assert PJ.running_totals(empty, "v", ["k"]).columns == ["k", "v", "running", "position"] and PJ.running_totals(empty, "v", ["k"]).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, None)], "k int, v double")
    assert sorted((r.position, r.running) for r in PJ.running_totals(nulls, "v", ["k"]).collect()) == [(1, None), (2, None)]


def test_business_days_are_added_as_numpy_adds_them(spark):
    rng = random.Random(3)
    rows = [(datetime.date(1999, 1, 1) + datetime.timedelta(days=rng.randrange(-60_000 if i % 5 == 0 else 0, 1500)), rng.randrange(-300, 300) if i % 3 else rng.randrange(-4, 4))
            for i in range(400)]
    rows += [(datetime.date(2001, 2, 24) + datetime.timedelta(days=i), n) for i in range(8) for n in (-2, -1, 0, 1, 2)]
    df = spark.createDataFrame([*rows, (None, 1), (rows[0][0], None)], "a date, n int")
    off = targets.HOLIDAYS_2001
    for r in df.select("a", "n", targets.add_busdays(F.col("a"), F.col("n"), off).alias("x"), targets.add_busdays(F.col("a"), F.col("n")).alias("y")).collect():
        if r.a is None or r.n is None:
            assert r.x is None and r.y is None
        else:
            assert r.x == np.busday_offset(r.a, r.n, roll="forward", holidays=off).item() and r.y == np.busday_offset(r.a, r.n, roll="forward").item()


def test_history_from_states_equals_each_period_by_itself(spark):
    rng = random.Random(5)
    day = datetime.date(1999, 12, 1)
    # orders come back in other months, some rows have no order, one client has several codes
    rows = [(None if i % 11 == 0 else f"o{rng.randrange(400)}", day + datetime.timedelta(days=rng.randrange(800)), rng.choice([1, 2, 3, 4, None]),
             D(rng.randrange(1, 10_000)) / 100, f"client {rng.randrange(3)}", rng.choice(["f", None]), "s") for i in range(3000)]
    sales = spark.createDataFrame(rows, "order_number string, invoice_date date, partner_code long, product_amount decimal(18,2), partner_name string, rfv_familia string, rfv_salesperson string")
    refs = ["2001-01-31", "2001-02-28", "2001-06-13", "2001-06-30", "2002-01-01"]
    got = com.rfv_history(sales, [*refs, refs[0]])
    want = None
    for r in refs:
        one = com.rfv_score(com.rfv_base(com.rolling_window(sales, "invoice_date", r, 12), r))
        want = one if want is None else want.unionByName(one)
    assert got.columns == want.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key) and got.count() > 20


def test_a_window_is_a_run_of_slots():
    cuts, slots = com.window_slots(["2001-01-31", "2001-02-15"], 12)
    assert cuts == ["2000-01-01", "2000-02-01", "2001-02-01", "2001-02-16"] and slots == {"2001-01-31": (1, 2), "2001-02-15": (2, 3)}


def _sales(spark):
    rng = random.Random(9)
    rows = [(datetime.date(2001, 1, 1) + datetime.timedelta(days=rng.randrange(365)), "hot" if i % 3 else rng.choice(["a", None]), rng.randrange(3000), D(rng.randrange(1, 100_000)) / 100,
             "x" if i % 4 == 0 else f"s{rng.randrange(20)}") for i in range(20_000)]
    rows += [(None, "a", 1, D("1"), "x"), (datetime.date(2001, 3, 5), "void", None, None, None), (datetime.date(2001, 4, 5), "void", None, None, None)]
    return rows, spark.createDataFrame(rows, "day date, k string, client long, v decimal(18,2), seller string")


def test_windows_of_monthly_states_are_near_the_exact_rows(spark, tmp_path):
    rows, df = _sales(spark)
    path = str(tmp_path / "states")
    partials.monthly_states(df, ["k"], "day", measure="v", distinct="client", item="seller").write.partitionBy("month").parquet(path)
    for first, last in (("2001-01-01", "2001-12-01"), ("2001-03-01", "2001-05-01"), ("2001-07-01", "2001-07-01")):
        lo, hi = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last)
        out = partials.over_months(spark.read.parquet(path), ["k"], first, last, top=2)
        files = out.inputFiles()
        assert files and all(path in f for f in files)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan and plan.count("FileScan") == 1
        mine = [r for r in rows if r[0] and lo <= r[0].replace(day=1) <= hi]
        got = {r.k: r for r in out.collect()}
        assert set(got) == {r[1] for r in mine}
        for k, g in got.items():
            part = [r for r in mine if r[1] == k]
            vals = sorted(float(r[3]) for r in part if r[3] is not None)
            assert (g.n_rows, g.amount) == (len(part), sum((r[3] for r in part if r[3] is not None), D(0)) if vals else None)
            exact = len({r[2] for r in part if r[2] is not None})
            assert abs(g.distinct - exact) <= 0.05 * exact
            if vals:
                assert np.searchsorted(vals, g.quantile, "left") / len(vals) <= 0.53 and np.searchsorted(vals, g.quantile, "right") / len(vals) >= 0.47
            else:
                assert g.quantile is None
            counts = sorted(Counter(r[4] for r in part).values(), reverse=True)
            assert [t["count"] for t in g.top] == counts[:2]


def test_states_of_no_rows(spark):
    _, df = _sales(spark)
    states = partials.monthly_states(df.limit(0), ["k"], "day", measure="v", distinct="client", item="seller")
    assert states.count() == 0 and partials.over_months(states, ["k"], "2001-01-01", "2001-12-01").count() == 0
