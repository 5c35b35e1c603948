"""Registered load and flattening queries: each writes with the operator under test and returns what is read back
(SRC-7, SNK-1..4, PRJ-4, 5, 9, 11..13, QLT-7, INC-4, 7, 12, A-QA-7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import increment as INC
from lakeops.operators import projection as PJ
from lakeops.operators import qa, quality
from lakeops.plans.registry import register
from lakeops.session import ensure_checkpoint_dir
from lakeops.sources import readers as R
from lakeops.sources import sinks as SK
from lakeops.streaming import bucketed as BK
from lakeops.streaming import upsert as UP


def _place(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeops-{name}-{uuid.uuid4().hex}"


def _raw(spark, sf, table):
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _orders(spark, sf):
    o = _raw(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("long").alias("order_key"), F.col("o_custkey").cast("long").alias("customer_key"),
                    F.col("o_orderdate").cast("date").alias("order_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"))


ORDERS = ("SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_custkey AS BIGINT) AS customer_key, CAST(o_orderdate AS DATE) AS order_date, "
          "CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders")


@register("json_records", "SELECT c_custkey AS doc, c_custkey AS id, c_name AS name FROM customer UNION ALL "
          "SELECT c_custkey, c_custkey + 1000000, upper(c_name) FROM customer WHERE c_custkey % 3 <> 2")
def q_json_records(spark, sf):
    c = _raw(spark, sf, "customer")
    one = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    two = F.array(one, F.struct((F.col("c_custkey") + 1000000).alias("id"), F.upper("c_name").alias("name")))
    k = F.col("c_custkey") % 3
    doc = F.when(k == 0, F.to_json(F.struct(two.alias("items")))).when(k == 1, F.to_json(F.struct(two.alias("results")))).otherwise(F.to_json(one))
    return R.json_records(c.select(F.col("c_custkey").alias("doc"), doc.alias("payload")), "payload",
                          T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))


@register("reload_orders", f"SELECT * FROM ({ORDERS}) o WHERE total > 1000")
def q_reload(spark, sf):
    """SNK-1: load the table, then reload it from itself."""
    path = _place(spark, "reload")
    SK.write_full(_orders(spark, sf), path)
    SK.write_full(spark.read.parquet(path).where("total > 1000"), path)
    return spark.read.parquet(path)


@register("guarded_reload", f"SELECT order_key, CAST(NULL AS VARCHAR) AS note, total FROM ({ORDERS}) o")
def q_guarded(spark, sf):
    """SNK-2: an empty extract leaves the table as it was; the schema order adds and drops columns."""
    path, o = _place(spark, "guarded"), _orders(spark, sf)
    schema = {"order_key": "bigint", "note": "string", "total": "decimal(18,2)"}
    SK.write_full_guarded(o, path, schema)
    SK.write_full_guarded(o.where("order_key < 0"), path, schema)
    return spark.read.parquet(path)


@register("append_orders", ORDERS)
def q_append(spark, sf):
    """SNK-3: two appends by date."""
    path, o = _place(spark, "append"), _orders(spark, sf)
    for cond in ("order_date < DATE '1995-01-01'", "order_date >= DATE '1995-01-01' OR order_date IS NULL"):
        SK.write_append(o.where(cond), path)
    return spark.read.parquet(path)


@register("partitioned_orders", f"""SELECT strftime(order_date, '%Y-%m') AS month, COUNT(*) AS orders,
  CAST(SUM(CASE WHEN strftime(order_date, '%Y-%m') = '1996-03' THEN total * 2 ELSE total END) AS DECIMAL(18,2)) AS total FROM ({ORDERS}) o GROUP BY 1""")
def q_partitioned(spark, sf):
    """SNK-4: month partitions; writing one month again replaces that month alone."""
    path, o = _place(spark, "months"), _orders(spark, sf)
    SK.write_partitioned(o, path, "order_date", cluster=["customer_key"])
    again = o.where("order_date >= DATE '1996-03-01' AND order_date < DATE '1996-04-01'").withColumn("total", (F.col("total") * 2).cast("decimal(18,2)"))
    SK.write_partitioned(again, path, "order_date")
    t = spark.read.parquet(path)
    return t.groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("orders"), F.sum("total").cast("decimal(18,2)").alias("total"))


@register("clustered_orders", f"""SELECT strftime(order_date, '%Y-%m') AS month, customer_key, COUNT(*) AS orders, CAST(SUM(total) AS DECIMAL(18,2)) AS total
  FROM ({ORDERS}) o GROUP BY 1, 2""")
def q_clustered(spark, sf):
    """SNK-4: month partitions whose files lie on a Z-order curve over customer and value."""
    path = _place(spark, "zorder")
    SK.write_partitioned(_orders(spark, sf), path, "order_date", cluster=["customer_key", "total"])
    t = spark.read.parquet(path)
    return t.groupBy(F.col("month").cast("string").alias("month"), "customer_key").agg(F.count("*").alias("orders"), F.sum("total").cast("decimal(18,2)").alias("total"))


STAMP = "2024-01-31 08:30:00"


@register("snapshot_suppliers", f"""SELECT s_suppkey, s_name, DATE '2024-01-31' AS snapshot_date, TIMESTAMP '{STAMP}' AS loaded_at, TIMESTAMP '{STAMP}' AS updated_at FROM supplier""")
def q_snapshot(spark, sf):
    s = _raw(spark, sf, "supplier").select("s_suppkey", "s_name")
    return PJ.add_audit(PJ.add_snapshot_date(s, "2024-01-31"), STAMP, updated=True)


@register("customers_without_pii", "SELECT c_custkey, c_name AS name, c_mktsegment AS work FROM customer")
def q_pii(spark, sf):
    c = _raw(spark, sf, "customer")
    person = F.struct(F.col("c_name").alias("name"), F.col("c_phone").alias("email") if "c_phone" in c.columns else F.lit("x").alias("email"),
                      F.struct(F.lit("home").alias("home"), F.col("c_mktsegment").alias("work")).alias("phones"))
    out = PJ.drop_pii(c.select("c_custkey", person.alias("person")), "person", drop=["email"], drop_in={"phones": ["home"]})
    # what is left of the person, all fields: a field that should have gone would be a column too many
    return out.select("c_custkey", "person.*").select("c_custkey", "name", "phones.*")


@register("custom_fields", """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Compra' ELSE event_type END AS segmento_cliente,
  CASE WHEN event_id % 2 = 0 THEN 'A, B' ELSE 'B' END AS linhas, CAST(event_id % 100 AS DOUBLE) / 4 AS valor, 'BRL' AS valor_currency FROM events""")
def q_custom(spark, sf):
    e = _raw(spark, sf, "events")
    i = F.col("event_id")
    money_ = F.concat(F.lit('{"value": '), ((i % 100).cast("double") / 4).cast("string"), F.lit(', "currency": "BRL"}'))
    m = F.create_map(F.lit("h1"), F.col("event_type"), F.lit("h2"), F.when(i % 2 == 0, "1,2").otherwise("2"), F.lit("h3"), money_)
    fields = [{"key": "h1", "name": "Segmento Cliente", "type": "enum", "options": {"purchase": "Compra"}},
              {"key": "h2", "name": "Linhas", "type": "set", "options": {"1": "A", "2": "B"}}, {"key": "h3", "name": "Valor", "type": "monetary"}]
    return PJ.flatten_custom_fields(e.select("event_id", m.alias("cf")), "cf", fields)


@register("mail_headers", """SELECT conv_id, turn, role AS from_addr, 'c' || CAST(conv_id AS VARCHAR) AS email_message_id,
  CAST(2 * (turn % 3) AS INTEGER) AS attachments, turn % 3 > 0 AS has_attachments FROM conversations""")
def q_mail(spark, sf):
    c = _raw(spark, sf, "conversations")
    head = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    file = F.struct(F.lit("a.pdf").alias("filename"), F.struct(F.lit("1").alias("attachmentId")).alias("body"))
    inline = F.struct(F.lit("inline.png").alias("filename"), F.struct(F.lit(None).cast("string").alias("attachmentId")).alias("body"))
    deep = F.struct(F.lit("b.zip").alias("filename"), F.struct(F.lit("2").alias("attachmentId")).alias("body"), F.array(file, inline).alias("parts"))
    parts = F.array_repeat(F.struct(F.lit("").alias("filename"), F.struct(F.lit(None).cast("string").alias("attachmentId")).alias("body"), F.array(deep).alias("parts")),
                           (F.col("turn") % 3).cast("int"))
    m = c.select("conv_id", "turn", F.array(head("From", F.col("role")), head("Message-ID", F.concat(F.lit("c"), F.col("conv_id")))).alias("headers"),
                 F.lit(0).alias("internal_date"), parts.alias("parts"))
    return PJ.flatten_mail(m).select("conv_id", "turn", "from_addr", "email_message_id", "attachments", "has_attachments")


@register("id_references", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS ref, 'mail' || CAST(o_custkey AS VARCHAR) AS email FROM orders")
def q_refs(spark, sf):
    o = _raw(spark, sf, "orders")
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey").cast("string")
    raw = F.when(k == 0, F.concat(F.lit('{"value": '), c, F.lit("}"))).when(k == 1, F.concat(F.lit('{"id": '), c, F.lit("}"))).otherwise(c)
    mails = F.array(F.struct(F.concat(F.lit("mail"), c).alias("value"), F.lit(True).alias("primary")), F.struct(F.lit("other").alias("value"), F.lit(False).alias("primary")))
    d = o.select("o_orderkey", raw.alias("raw"), mails.alias("mails"))
    return d.select("o_orderkey", PJ.norm_ref("raw").alias("ref"), PJ.first_of("mails").alias("email"))


@register("transform_suppliers", f"""SELECT DISTINCT CAST(s_suppkey AS BIGINT) AS code, CASE WHEN s_suppkey % 2 = 0 THEN 'SÃO ' ELSE '' END || s_name AS name,
  CAST(s_acctbal AS DOUBLE) AS balance, DATE '2024-01-31' AS snapshot_date, TIMESTAMP '{STAMP}' AS loaded_at FROM supplier""")
def q_transform(spark, sf):
    """QLT-7 over suppliers with repeated rows, padded names and a corrupted term."""
    s = _raw(spark, sf, "supplier")
    rows = s.select(F.col("s_suppkey").cast("string").alias("code"),
                    F.concat(F.lit("  "), F.when(F.col("s_suppkey") % 2 == 0, "S?O ").otherwise(""), F.col("s_name"), F.lit(" ")).alias("name"),
                    F.col("s_acctbal").cast("string").alias("balance"))
    pats = spark.createDataFrame([("S?O", "SÃO")], "pattern string, replacement string")
    out = quality.transform_entity(rows.unionByName(rows), {"code": "bigint", "name": "string", "balance": "double"}, ["code"], "2024-01-31", STAMP,
                                   repair=("name", pats))
    return out.select("code", "name", "balance", "snapshot_date", "loaded_at")


def _cycle(spark, sf):
    """A full load, then an incremental one of a later extract in which some orders have changed."""
    root, control = _place(spark, "cycle"), _place(spark, "control")
    o = _orders(spark, sf).withColumn("updated_at", F.col("order_date").cast("timestamp_ntz"))
    args = dict(root=root, keys=["order_key"], order_by=["updated_at"], watermark_col="updated_at", control_path=control, entity="orders")
    UP.run_entity(spark, o, **args)
    late = o.where("total > 200000").withColumns({"total": (F.col("total") + 1).cast("decimal(18,2)"), "updated_at": F.lit("2030-01-01").cast("timestamp_ntz")})
    return UP.run_entity(spark, late, **args), UP.read_target(spark, root, o.schema)


@register("incremental_orders", f"""SELECT order_key, customer_key, order_date, CAST(total + CASE WHEN total > 200000 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS total,
  CASE WHEN total > 200000 THEN TIMESTAMP '2030-01-01' ELSE CAST(order_date AS TIMESTAMP) END AS updated_at FROM ({ORDERS}) o""")
def q_incremental(spark, sf):
    return _cycle(spark, sf)[1]


@register("merge_buckets", f"""SELECT order_key, customer_key, order_date, CAST(total + CASE WHEN total > 200000 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS total,
  CASE WHEN total > 200000 THEN 2 ELSE 1 END AS version FROM ({ORDERS}) o""")
def q_merge_buckets(spark, sf):
    """CDC-1, INC-12 on the bucketed table: changed orders come first, then all of them in their older version, which changes none of those."""
    root, o = _place(spark, "buckets"), _orders(spark, sf).withColumn("version", F.lit(1))
    changed = o.where("total > 200000").withColumns({"total": (F.col("total") + 1).cast("decimal(18,2)"), "version": F.lit(2)})
    for delta in (changed, o):
        BK.merge(delta, root, ["order_key"], ["version"], o.schema, newest=True)
    return BK.read(spark, root, o.schema)


@register("run_log", f"""SELECT 'orders' AS entity, 'ok' AS status, 'incremental' AS mode, COUNT(*) FILTER (total > 200000) AS rows_extracted, COUNT(*) AS rows_loaded
  FROM ({ORDERS}) o""")
def q_run_log(spark, sf):
    """INC-7: the row of the cycle above, appended to a log and read back."""
    run, target = _cycle(spark, sf)
    log = _place(spark, "runs")
    n = _orders(spark, sf).where("total > 200000").count()
    SK.write_append(INC.record_run(spark, "r1", "erp", run["entity"], run["status"], n, target.count(), None, None, 1.0, run["mode"]), log)
    return spark.read.parquet(log).select("entity", "status", "mode", "rows_extracted", "rows_loaded")


@register("stream_orders", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def q_stream(spark, sf):
    """INC-12: the table's files as a stream, upserted by key."""
    schema = _raw(spark, sf, "orders").schema
    root = _place(spark, "stream")
    q = UP.stream_upsert(spark, f"{sf}/orders.parquet*", schema, root, ["o_orderkey"], ["o_orderdate", "o_totalprice"], name=f"orders-{uuid.uuid4().hex}")
    q.awaitTermination()
    t = UP.read_target(spark, root, schema)
    return t.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), F.col("o_totalprice").cast("double").alias("o_totalprice"))


@register("gold_or_bronze", f"SELECT 'bronze' AS layer, COUNT(*) AS orders FROM orders UNION ALL SELECT 'gold', COUNT(*) FROM ({ORDERS}) o WHERE total > 1000")
def q_layer(spark, sf):
    """A-QA-7: the bronze rows while there is no gold table, the gold table once it is there."""
    path, o = _place(spark, "gold"), _orders(spark, sf)
    count = lambda layer: qa.read_layer(spark, path, lambda: o).agg(F.count("*").alias("orders")).select(F.lit(layer).alias("layer"), "orders")
    before = count("bronze")
    SK.write_full(o.where("total > 1000"), path)
    return before.unionByName(count("gold"))
