"""Customer service: tickets and resolution, SLA, first reply from raw chat JSON, calls, chats (A-SAC-1..4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import columns as C


def _hours(now: str):
    """Whole hours from opening to closing (won or lost); an open ticket runs until ``now``."""
    return F.expr(f"timestampdiff(HOUR, add_time, coalesce(won_time, lost_time, TIMESTAMP_NTZ '{now}'))")


def _month(c: str = "add_time"):
    return F.trunc(F.col(c).cast("date"), "month").alias("month")


def tickets(deals: DataFrame, now: str) -> DataFrame:
    """A-SAC-1: by month of opening x pipeline x status: tickets and mean whole hours (still open -> until ``now``)."""
    t = deals.where(F.col("add_time").isNotNull())
    return t.groupBy(_month(), "pipeline_id", F.coalesce("status", F.lit("open")).alias("status")).agg(
        F.count("*").alias("tickets"), F.avg(_hours(now)).alias("mean_hours"))


def resolution_rate(deals: DataFrame, now: str) -> DataFrame:
    """A-SAC-1: per month of opening and over all months (month NULL): tickets, resolved (won), still open,
    resolved share and mean hours, which weighs each ticket once."""
    t = deals.where(F.col("add_time").isNotNull()).withColumn("month", _month()).withColumn("_h", _hours(now))
    st = F.coalesce("status", F.lit("open"))
    m = t.rollup("month").agg(F.count("*").alias("tickets"), C.count_if(st == "won").alias("resolved"),
                              C.count_if(~st.isin("won", "lost")).alias("open"), F.avg("_h").alias("mean_hours"))
    return m.withColumn("resolution_pct", C.pct("resolved", "tickets"))


def sla_resolution(deals: DataFrame, now: str) -> DataFrame:
    """A-SAC-2: tickets and mean whole hours per month of opening, open tickets running until ``now``."""
    t = deals.where(F.col("add_time").isNotNull())
    return t.groupBy(_month()).agg(F.count("*").alias("tickets"), F.avg(_hours(now)).alias("mean_hours"))


def with_variant(df: DataFrame, json_col: str = "payload_json", name: str = "payload") -> DataFrame:
    """PRJ-10: the JSON text column parsed once into a VARIANT, null where it is no JSON; the text goes.

    To be stored: a table written from it is read by path without any parsing (``first_reply``, ``chats_summary`` and
    ``chat_panel`` take either form of the column).
    """
    return df.withColumn("_parsed", F.try_parse_json(json_col)).drop(json_col).withColumnRenamed("_parsed", name)


def _field(df: DataFrame, col: str, path: str) -> Column:
    """The scalar at a path as text, from a VARIANT column or one of JSON text; null where there is none."""
    if isinstance(df.schema[col].dataType, T.VariantType):
        return F.try_variant_get(col, path, "string")
    return F.get_json_object(col, path)


def first_reply(chats: DataFrame, sector: str = "SAC", json_col: str = "payload_json") -> DataFrame:
    """A-SAC-2: per month, median minutes from first contact to first member reply of one sector, read by path.

    Negative gaps are dropped; the median is a sketch (bounded memory per group at any size).
    """
    first = _field(chats, json_col, "$.firstContactMessage.eventAtUTC").try_cast("timestamp_ntz")
    reply = _field(chats, json_col, "$.firstMemberReplyMessage.eventAtUTC").try_cast("timestamp_ntz")
    created = _field(chats, json_col, "$.createdAtUTC").try_cast("timestamp_ntz")
    of = _field(chats, json_col, "$.sector.name")
    df = chats.where(of == sector).select(created.alias("created"), first.alias("first"), reply.alias("reply"))
    mins = F.expr("timestampdiff(MINUTE, first, reply)")
    df = df.withColumn("minutes", mins).where(F.col("minutes") >= 0)
    return df.groupBy(_month("created")).agg(
        F.count("*").alias("replied"), F.percentile_approx("minutes", 0.5, 100000).cast("bigint").alias("median_minutes"))


def first_reply_kpi(monthly: DataFrame) -> DataFrame:
    """A-SAC-2: median of the monthly medians (the mean of the middle two for an even number of months)."""
    return monthly.agg(F.percentile("median_minutes", 0.5).alias("median_minutes"), F.count("*").alias("months"))


def calls_summary(calls: DataFrame) -> DataFrame:
    """A-SAC-3: calls by month x direction x sentiment: count, minutes, mean minutes."""
    g = calls.groupBy(F.trunc(F.col("call_created").cast("date"), "month").alias("month"), "direction", "ai_sentiment").agg(
        F.count("*").alias("calls"), (F.sum("duration_seconds").cast("double") / F.lit(60.0)).alias("minutes"))
    return g.withColumn("mean_minutes", C.safe_div("minutes", "calls"))


def calls_window(calls: DataFrame) -> DataFrame:
    """A-SAC-3: covered window of the call data."""
    return calls.agg(F.min("call_created").alias("first_call"), F.max("call_created").alias("last_call"),
                     F.count("*").alias("calls"))


def chats_summary(chats: DataFrame, sector: str | None = None, json_col: str = "payload_json") -> DataFrame:
    """A-SAC-4: chats by month x channel with open count (optionally one sector), read by path."""
    df = chats.select(
        _field(chats, json_col, "$.createdAtUTC").try_cast("timestamp_ntz").alias("created"),
        _field(chats, json_col, "$.sector.name").alias("sector"),
        _field(chats, json_col, "$.channel.name").alias("channel"),
        _field(chats, json_col, "$.open").try_cast("boolean").alias("is_open"))
    if sector:
        df = df.where(F.col("sector") == sector)
    return df.groupBy(F.trunc(F.col("created").cast("date"), "month").alias("month"), "channel").agg(
        F.count("*").alias("chats"), C.count_if(F.coalesce("is_open", F.lit(False))).alias("open"))


def chat_panel(chats: DataFrame, json_col: str = "payload") -> DataFrame:
    """A-SAC-2 and A-SAC-4 in one pass: per month x sector, chats, open ones, replied ones and the median minutes to the first reply."""
    at = {"created": "$.createdAtUTC", "first": "$.firstContactMessage.eventAtUTC", "reply": "$.firstMemberReplyMessage.eventAtUTC"}
    df = chats.select(*(_field(chats, json_col, p).try_cast("timestamp_ntz").alias(c) for c, p in at.items()),
                      _field(chats, json_col, "$.sector.name").alias("sector"), _field(chats, json_col, "$.open").try_cast("boolean").alias("is_open"))
    gap = F.expr("timestampdiff(MINUTE, first, reply)")
    waited = F.when(gap >= 0, gap)
    return df.groupBy(_month("created"), "sector").agg(
        F.count("*").alias("chats"), C.count_if(F.coalesce("is_open", F.lit(False))).alias("open"), F.count(waited).alias("replied"),
        F.percentile_approx(waited, 0.5, 100000).cast("bigint").alias("median_minutes"))
