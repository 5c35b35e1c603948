"""RFV boundary cases on hand-made frames (frequency 1..7, recency 30/31/60/61/...)."""
import datetime as dt

from lakeops.operators import commercial as com


def _base(spark, rows):
    return spark.createDataFrame(rows, "partner_name string, rfv_familia string, rfv_salesperson string, "
                                       "frequency bigint, recency_days int")


def test_frequency_bands(spark):
    rows = [(f"C{f}", fam, "S", f, 10) for f in range(1, 8) for fam in ("HOSPITALAR", "FARMACIAS")]
    out = {(r.partner_name, r.rfv_familia): r.freq_bucket for r in com.rfv_score(_base(spark, rows)).collect()}
    hosp = [out[(f"C{f}", "HOSPITALAR")] for f in range(1, 8)]
    farm = [out[(f"C{f}", "FARMACIAS")] for f in range(1, 8)]
    assert hosp == ["F5", "F4", "F3", "F2", "F1", "F1", "F1"]
    assert farm == ["F5", "F4", "F3", "F3", "F2", "F2", "F1"]


def test_recency_bands_and_segments(spark):
    days = [0, 30, 31, 60, 61, 120, 121, 180, 181]
    rows = [(f"C{d}", "HOSPITALAR", "S", 5, d) for d in days]
    out = {r.partner_name: (r.rec_bucket, r.segment_num, r.segment) for r in com.rfv_score(_base(spark, rows)).collect()}
    assert [out[f"C{d}"][0] for d in days] == ["R1", "R1", "R2", "R2", "R3", "R3", "R4", "R4", "R5"]
    assert out["C0"][1:] == (1, "Campeões")
    assert out["C181"][1] == 8


def test_unknown_cell_is_99(spark):
    rows = [("X", "HOSPITALAR", "S", 5, None)]
    r = com.rfv_score(_base(spark, rows)).collect()[0]
    assert r.rec_bucket == "R5" and r.segment_num == 8  # NULL recency falls to the last band
    df = com.rfv_score(_base(spark, rows)).withColumn("cell", com.F.lit("ZZ"))
    assert df.collect()[0].cell == "ZZ"


def test_rfv_base_counts_distinct_orders(spark):
    sales = spark.createDataFrame(
        [("o1", dt.date(2001, 7, 1), 1, "A", "HOSPITALAR", "S", 10.0),
         ("o1", dt.date(2001, 7, 1), 1, "A", "HOSPITALAR", "S", 5.0),
         ("o2", dt.date(2001, 7, 20), 2, "A", "HOSPITALAR", "S", 1.0)],
        "order_number string, invoice_date date, partner_code bigint, partner_name string, rfv_familia string, "
        "rfv_salesperson string, product_amount double").withColumn(
        "product_amount", com.F.col("product_amount").cast("decimal(18,2)"))
    r = com.rfv_base(sales, "2001-08-01").collect()[0]
    assert r.frequency == 2 and r.recency_days == 12 and r.partner_codes == "1,2" and float(r.total_value) == 16.0


def test_history_refs_cover_window(spark):
    refs = com.month_end_refs("2000-12-31", 3)
    assert refs == ["2000-12-31", "2001-01-31", "2001-02-28"]
