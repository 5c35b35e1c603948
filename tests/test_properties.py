"""Property and fixture tests in the style of the source system's own tests: a file tree read through the
binaryFile source (extension filter, SHA-256), calendar helpers against Python's calendar, and the RFV
invariant that every client lands in exactly one matrix cell."""
import datetime as dt
import hashlib
import os
import tempfile

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions import columns as C
from lakeops.operators import cdc, commercial as com
from lakeops.sources.driver import DriverTables

from conftest import SF_SMALL


def test_binary_file_catalog(spark):
    root = tempfile.mkdtemp(prefix="lakeops-files-")
    files = {"a/contrato.pdf": b"%PDF-1.4 one", "a/b/planilha.XLSX": b"x" * 100, "c/nota.docx": b"docx",
             "c/foto.png": b"\x89PNG"}
    for rel, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
        with open(f"{root}/{rel}", "wb") as fh:
            fh.write(data)
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
           .select(F.regexp_replace("path", "^file:", "").alias("file_path"), "content"))
    official = spark.createDataFrame([(f"{root}/a",)], "directory string")
    cat = {r.file_name: r for r in cdc.build_catalog(raw, ["pdf", "xlsx", "docx"], official).collect()}
    assert set(cat) == {"contrato.pdf", "planilha.XLSX", "nota.docx"}
    assert cat["planilha.XLSX"].extension == "xlsx" and cat["planilha.XLSX"].size_bytes == 100
    assert cat["contrato.pdf"].content_hash == hashlib.sha256(files["a/contrato.pdf"]).hexdigest()
    assert cat["contrato.pdf"].is_official and not cat["nota.docx"].is_official


dates = st.dates(min_value=dt.date(1996, 1, 1), max_value=dt.date(2030, 12, 31))


@settings(max_examples=25, deadline=None)
@given(st.lists(dates, min_size=1, max_size=20))
def test_calendar_helpers(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select("d", C.week_of_month("d").alias("w"), C.week_label("d").alias("lbl"),
                     C.rolling_year_start(F.col("d")).alias("ys")).collect()
    for r in rows:
        d = r.d
        w = (d.day - 1) // 7 + 1
        start = (w - 1) * 7 + 1
        last = (dt.date(d.year + d.month // 12, d.month % 12 + 1, 1) - dt.timedelta(days=1)).day
        assert r.w == w and r.lbl == f"{start:02d}-{min(start + 6, last):02d}"
        assert r.ys == dt.date(d.year - 1, d.month, 1)


def test_every_client_in_one_cell(spark):
    T = DriverTables(spark, SF_SMALL)
    s = com.silver_sales(T.sales_order, T.nature, T.group_family, T.portfolio, "2001-08-01", lookback_months=36)
    score = com.rfv_score(com.rfv_base(s, "2001-08-01"))
    dup = score.groupBy("partner_name", "rfv_familia", "rfv_salesperson").agg(F.countDistinct("cell").alias("n")).where("n <> 1")
    assert dup.count() == 0
    assert score.where(F.col("segment_num") == 99).count() == 0
