"""Platform operators without a registered query: streaming upsert, incremental cycle, sinks,
JSON record roots, PII removal, custom fields, mail headers, gold/bronze fallback."""
import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from lakeops.operators import cdc, projection as PJ, qa
from lakeops.sources import readers as R
from lakeops.sources import sinks as SK
from lakeops.sources.driver import DriverTables
from lakeops.streaming import upsert as ST

from conftest import SF_SMALL

COLS = ["order_number", "partner_code", "order_date", "product_amount", "updated_at"]


def _orders(spark):
    return DriverTables(spark, SF_SMALL).sales_order.select(*COLS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_upsert_matches_batch_and_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="lakeops-stream-")
    src, root, ctl = f"{base}/in", f"{base}/target", f"{base}/control"
    o = _orders(spark)
    k = F.col("order_number").cast("bigint")
    d1 = o.where(k % 3 == 0)
    d2 = o.where(k % 3 == 1).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    d3 = o.where(k % 6 == 0).withColumn("product_amount", (F.col("product_amount") + 1).cast("decimal(18,2)")) \
        .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 2 DAY"))
    for i, d in enumerate([d1, d2, d3]):
        d.coalesce(1).write.parquet(f"{src}/batch={i}")
        os.replace(next(p for p in [os.path.join(f"{src}/batch={i}", f) for f in os.listdir(f"{src}/batch={i}")]
                        if p.endswith(".parquet")), f"{src}/part-{i}.parquet")
    name = f"t{uuid.uuid4().hex[:8]}"
    q = ST.stream_upsert(spark, f"{src}/*.parquet", o.schema, root, ["order_number"], ["updated_at"], name=name,
                         watermark_col="updated_at", control_path=ctl, max_files_per_trigger=1)
    q.awaitTermination(300)
    got = ST.read_target(spark, root, o.schema)
    exp = cdc.upsert(spark.createDataFrame([], o.schema), d1.unionByName(d2).unionByName(d3), "order_number", "updated_at")
    assert _rows(got) == _rows(exp)
    n_versions = len(ST.list_versions(spark, root))
    q2 = ST.stream_upsert(spark, f"{src}/*.parquet", o.schema, root, ["order_number"], ["updated_at"], name=name,
                          watermark_col="updated_at", control_path=ctl)
    q2.awaitTermination(300)
    assert len(ST.list_versions(spark, root)) == n_versions  # replay: nothing new
    assert ST.read_control(spark, ctl, name) is not None


def test_run_entity_full_then_incremental(spark):
    base = tempfile.mkdtemp(prefix="lakeops-run-")
    o = _orders(spark)
    r1 = ST.run_entity(spark, o, root=f"{base}/t", keys=["order_number"], order_by=["updated_at"], watermark_col="updated_at",
                       control_path=f"{base}/c", entity="orders", incremental=True)
    assert r1["mode"] == "full" and r1["status"] == "ok"
    changed = o.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 400 DAY"))
    r2 = ST.run_entity(spark, changed, root=f"{base}/t", keys=["order_number"], order_by=["updated_at"],
                       watermark_col="updated_at", control_path=f"{base}/c", entity="orders", overlap_days=1)
    assert r2["mode"] == "incremental"
    assert ST.read_target(spark, f"{base}/t", o.schema).count() == o.count()


def test_upsert_is_idempotent(spark):
    o = _orders(spark)
    d = o.where(F.col("partner_code") % 2 == 0).withColumn("product_amount", F.lit(1).cast("decimal(18,2)"))
    once = cdc.upsert(o, d, "order_number")
    twice = cdc.upsert(once, d, "order_number")
    assert _rows(once) == _rows(twice)


def test_sinks_guard_partition_and_counts(spark):
    base = tempfile.mkdtemp(prefix="lakeops-sink-")
    o = _orders(spark)
    assert SK.write_full_guarded(o.limit(0), f"{base}/empty")["status"] == "skipped"
    assert SK.write_full_guarded(o, f"{base}/full", {"order_number": "string", "missing": "int"})["status"] == "ok"
    assert spark.read.parquet(f"{base}/full").columns == ["order_number", "missing"]
    SK.write_partitioned(o, f"{base}/part", "order_date", cluster=["partner_code"])
    one_month = o.where(F.date_format("order_date", "yyyy-MM") == "1998-01").withColumn("product_amount", F.lit(0).cast("decimal(18,2)"))
    SK.write_partitioned(one_month, f"{base}/part", "order_date")
    back = spark.read.parquet(f"{base}/part")
    assert back.count() == o.count()
    assert back.where((F.col("month") == "1998-01") & (F.col("product_amount") != 0)).count() == 0
    v = SK.validate_counts(SK.counts({"a": o, "b": o}), SK.counts({"a": o, "c": o})).collect()
    got = {r.entity: (r.expected, r.actual, r.ok) for r in v}
    assert got["a"][2] and got["b"][1] == -1 and got["c"][0] == -1


def test_json_records_tolerant_root(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    docs = [json.dumps({"items": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]}), json.dumps({"data": [{"id": 3}]}),
            json.dumps({"id": 4, "name": "d"}), json.dumps({"payload": {"rows": [{"id": 5}]}})]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "k int, doc string")
    got = sorted(r.id for r in R.json_records(df.where("k < 3"), "doc", schema).collect())
    assert got == [1, 2, 3, 4]
    got2 = [r.id for r in R.json_records(df.where("k = 3"), "doc", schema, data_path="payload.rows").collect()]
    assert got2 == [5]


def test_drop_pii_and_envelope(spark):
    df = spark.createDataFrame([(1, ("Ana", "a@x", ("1", "2")))],
                               "id int, person struct<name:string,email:string,phones:struct<home:string,work:string>>")
    out = PJ.drop_pii(df, "person", drop=["email"], drop_in={"phones": ["home"]})
    assert out.schema["person"].dataType.simpleString() == "struct<name:string,phones:struct<work:string>>"
    env = PJ.to_envelope(df.select("id", F.lit("x").alias("secret"), F.lit("v").alias("a")), "src", "r1", "2024-01-01 00:00:00",
                         "id", None, drop=["secret"]).collect()[0]
    assert json.loads(env.payload_json) == {"a": "v", "id": 1} and env.record_id == "1"


def test_flatten_custom_fields_and_mail(spark):
    df = spark.createDataFrame([(1, {"h1": "7", "h2": "1,2", "h3": '{"value": 10.5, "currency": "BRL"}', "h4": "txt"})],
                               "id int, cf map<string,string>")
    fields = [{"key": "h1", "name": "Segmento Cliente", "type": "enum", "options": {"7": "Hospital"}},
              {"key": "h2", "name": "Linhas", "type": "set", "options": {"1": "A", "2": "B"}},
              {"key": "h3", "name": "Valor", "type": "monetary"}, {"key": "h4", "name": "Obs."}]
    r = PJ.flatten_custom_fields(df, "cf", fields).collect()[0]
    assert (r.segmento_cliente, r.linhas, r.valor, r.valor_currency, r.obs) == ("Hospital", "A, B", 10.5, "BRL", "txt")
    mail = spark.createDataFrame(
        [([("From", "a@x"), ("Subject", "Oi")], 1704067200000,
          [("f.pdf", [("g.png", None)]), ("", None)])],
        "headers array<struct<name:string,value:string>>, internal_date long, "
        "parts array<struct<filename:string,parts:array<struct<filename:string,parts:string>>>>")
    m = PJ.flatten_mail(mail).collect()[0]
    assert m.from_addr == "a@x" and m.subject == "Oi" and m.attachments == 2
    ref = spark.createDataFrame([('{"value": 5}',), ("9",)], "x string").select(PJ.norm_ref("x").alias("id")).collect()
    assert [r.id for r in ref] == ["5", "9"]


def test_read_layer_falls_back(spark):
    base = tempfile.mkdtemp(prefix="lakeops-layer-")
    o = _orders(spark)
    assert qa.read_layer(spark, f"{base}/gold", lambda: o.limit(3)).count() == 3
    o.limit(5).write.parquet(f"{base}/gold")
    assert qa.read_layer(spark, f"{base}/gold", lambda: o.limit(3)).count() == 5
