"""CRM and customer-360 analytics (A-COM-6..16, 25..27, 32, 37, 38).

Pre-aggregate before joining (deal metrics per org, calls per user) so every
join below the 360 view is one-row-per-key on the right; alerts are produced
in one pass over the 360 rows (``explode(filter(array(...)))``) instead of one
scan per alert type.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C

def _now(now: str) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def live_deals(deals: DataFrame) -> DataFrame:
    """FLT-4: NULL-safe 'not deleted'."""
    return deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False)))


def latest_snapshot(df: DataFrame, col: str) -> DataFrame:
    """FLT-6: rows of the latest snapshot (1-row aggregate joined back)."""
    return df.join(F.broadcast(df.agg(F.max(col).alias(col))), col)


def deal_metrics(deals: DataFrame, now: str, won_days: int = P.WON_LOOKBACK_DAYS) -> DataFrame:
    """A-COM-7: per org: total / open / won / lost, open value, won value in the last year, last created, next close."""
    d = live_deals(deals)
    st = F.col("status")
    won_recent = (st == "won") & (F.col("won_time") >= _now(now) - F.make_dt_interval(F.lit(won_days)))
    return d.groupBy("org_id").agg(
        F.count("*").alias("deals_total"), C.count_if(st == "open").alias("deals_open"),
        C.count_if(st == "won").alias("deals_won"), C.count_if(st == "lost").alias("deals_lost"),
        C.money(F.coalesce(F.sum(F.when(st == "open", F.col("value"))), F.lit(0))).alias("open_value"),
        C.money(F.coalesce(F.sum(F.when(won_recent, F.col("value"))), F.lit(0))).alias("won_value_12m"),
        F.max("add_time").alias("last_deal_at"),
        F.max(F.when(st == "open", F.col("expected_close_date"))).alias("next_close"),
    )


def customer_360(portfolio: DataFrame, score: DataFrame, bridge_best: DataFrame, metrics: DataFrame, now: str) -> DataFrame:
    """A-COM-6: active portfolio x latest RFV x best CRM org x deal metrics, with the five flags."""
    pf = portfolio.where(F.col("is_active")).select("partner_code", "partner_name", "rfv_familia",
                                                   F.col("salesperson_name").alias("rfv_salesperson"))
    sc = latest_snapshot(score, "ref_date").select(
        "partner_name", "rfv_familia", F.col("segment").alias("_seg"), F.col("segment_num").alias("_segn"),
        "freq_bucket", "rec_bucket", "frequency", "recency_days", F.col("total_value").alias("_val"))
    br = bridge_best.select("partner_code", "org_id", "org_name", F.col("match_type").alias("bridge_match_type"))
    j = pf.join(sc, ["partner_name", "rfv_familia"], "left").join(br, "partner_code", "left").join(metrics, "org_id", "left")
    segn = F.coalesce(F.col("_segn"), F.lit(P.SEGMENT_UNKNOWN))
    open_ = F.coalesce(F.col("deals_open"), F.lit(0))
    days = F.datediff(_now(now).cast("date"), F.col("last_deal_at").cast("date")).cast("int")
    val = F.coalesce(F.col("_val"), F.lit(0))
    return j.select(
        "partner_code", "partner_name", "rfv_familia", "rfv_salesperson",
        F.coalesce(F.col("_seg"), F.lit(P.NO_RFV_LABEL)).alias("segment"), segn.cast("int").alias("segment_num"),
        "freq_bucket", "rec_bucket", "frequency", "recency_days", C.money(val).alias("revenue"),
        "org_id", "org_name", "bridge_match_type",
        F.coalesce("deals_total", F.lit(0)).alias("deals_total"), open_.alias("deals_open"),
        F.coalesce("deals_won", F.lit(0)).alias("deals_won"),
        C.money(F.coalesce("open_value", F.lit(0))).alias("open_value"),
        C.money(F.coalesce("won_value_12m", F.lit(0))).alias("won_value_12m"),
        "last_deal_at", "next_close", days.alias("days_without_deal"),
        (segn.isin(*P.FLAG_OPPORTUNITY_SEGMENTS) & (open_ == 0)).alias("flag_opportunity"),
        (segn.isin(*P.FLAG_CHURN_SEGMENTS) & (open_ == 0)
         & (F.col("last_deal_at").isNull() | (days > P.FLAG_CHURN_SILENT_DAYS))).alias("flag_silent_churn"),
        (segn.isin(*P.FLAG_CHURN_SEGMENTS) & (open_ > 0)).alias("flag_recovery"),
        ((segn == P.FLAG_REACTIVATION_SEGMENT) & (val > P.FLAG_REACTIVATION_MIN_VALUE)).alias("flag_reactivation"),
        F.col("org_id").isNull().alias("flag_off_radar"),
    )


ALERT_FLAGS = ["flag_opportunity", "flag_silent_churn", "flag_recovery", "flag_reactivation", "flag_off_radar"]


def _message(template: str, fields: dict[str, Column]) -> Column:
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts.append(F.lit(template[pos:m.start()]))
        parts.append(fields[m.group(1)])
        pos = m.end()
    parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def alerts(c360: DataFrame, alert_defs=P.ALERTS) -> DataFrame:
    """A-COM-8: one row per client x raised alert (type, message, priority), one pass over the 360 rows."""
    fields = {"seg": F.col("segment"), "rev": C.round_units_text("revenue"),
              "days": F.coalesce(F.col("days_without_deal"), F.lit(999)).cast("string"),
              "open": F.col("deals_open").cast("string"), "pipe": C.round_units_text("open_value")}
    items = []
    for (typ, prio, tpl), flag in zip(alert_defs, ALERT_FLAGS):
        cond = F.col(flag)
        if flag == "flag_off_radar":
            cond = cond & (F.coalesce(F.col("revenue"), F.lit(0)) > 0)
        items.append(F.struct(cond.alias("on"), F.lit(typ).alias("alert_type"), _message(tpl, fields).alias("message"),
                              F.lit(prio).alias("priority")))
    base = ["partner_code", "partner_name", "rfv_familia", "rfv_salesperson", "segment", "segment_num", "revenue"]
    ex = c360.select(*base, "org_id", "org_name", "deals_open", "open_value", "days_without_deal",
                     F.explode(F.filter(F.array(*items), lambda x: x["on"])).alias("a"))
    off = F.col("a.alert_type") == "FORA_DO_RADAR_CRM"
    return ex.select(
        *base,
        F.when(off, F.lit(None)).otherwise(F.col("org_id")).alias("org_id"),
        F.when(off, F.lit(None)).otherwise(F.col("org_name")).alias("org_name"),
        F.when(off, F.lit(0)).otherwise(F.col("deals_open")).cast("bigint").alias("deals_open"),
        C.money(F.when(off, F.lit(0)).otherwise(F.col("open_value"))).alias("open_value"),
        F.when(off, F.lit(None)).otherwise(F.col("days_without_deal")).cast("int").alias("days_without_deal"),
        "a.alert_type", "a.message", F.col("a.priority").cast("int").alias("priority"))


def alert_digest(alert_rows: DataFrame) -> DataFrame:
    """A-COM-12: dedup by normalised company name x type (max revenue), then count and value per type."""
    d = alert_rows.groupBy(C.norm_name("partner_name").alias("name_norm"), "alert_type", "priority").agg(
        F.max("revenue").alias("revenue"))
    return d.groupBy("alert_type", "priority").agg(F.count("*").alias("companies"), C.money_sum("revenue").alias("revenue"))


def alert_detail(alert_rows: DataFrame, bridge: DataFrame, alert_type: str) -> DataFrame:
    """A-COM-13: per company for one alert type: branches, families, owners, segments, revenue, open deals and
    their value, days without a deal, and whether (and as what) the bridge knows the company in the CRM."""
    a = alert_rows.where(F.col("alert_type") == alert_type)

    def lst(c, sep=", "):
        return F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), sep)

    g = a.groupBy(C.norm_name("partner_name").alias("company")).agg(
        F.countDistinct("partner_code").alias("branches"), lst("rfv_familia", " + ").alias("families"),
        lst("rfv_salesperson").alias("owners"), lst("segment").alias("segments"), F.max("revenue").alias("revenue"),
        F.max("deals_open").alias("deals_open"), F.max("open_value").alias("open_value"),
        F.min("days_without_deal").alias("days_without_deal"), F.min("message").alias("message"))
    known = bridge.where(F.col("partner_name").isNotNull()).groupBy(C.norm_name("partner_name").alias("company")).agg(
        F.max(F.col("org_id").isNotNull()).alias("in_crm"), lst("org_name").alias("crm_names"))
    return g.join(known, "company", "left").withColumn("in_crm", F.coalesce("in_crm", F.lit(False)))


def deal_stage_health(deals: DataFrame, stages: DataFrame, now: str) -> DataFrame:
    """A-COM-11: by pipeline x stage x status: deals, value, mean value, mean days in stage, most frequent lost reason.

    The reason is the most frequent value over all deals of the group, none included; of equal counts the larger text.
    """
    d = live_deals(deals)
    keys = ["pipeline_id", "stage_id", "status"]
    days = F.datediff(_now(now).cast("date"), F.col("stage_change_time").cast("date"))
    agg = d.groupBy(*keys).agg(
        F.count("*").alias("deals"), C.money_sum("value").alias("value"),
        C.safe_div(F.sum("value"), F.count("value")).alias("mean_value"), F.avg(days).alias("mean_days_in_stage"))
    reasons = d.groupBy(*keys, "lost_reason").agg(F.count("*").alias("n"))
    top = reasons.groupBy(*keys).agg(F.max(F.struct("n", "lost_reason")).alias("t")).select(*keys, F.col("t.lost_reason").alias("top_lost_reason"))
    both = agg.alias("a").join(top.alias("t"), [F.col(f"a.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    out = both.select("a.*", "t.top_lost_reason")
    return out.join(F.broadcast(stages.select("stage_id", "stage_name", "order_nr")), "stage_id")


def funnel_status(deals: DataFrame) -> DataFrame:
    """A-COM-25: deals and value by status."""
    return live_deals(deals).groupBy("status").agg(F.count("*").alias("deals"), C.money_sum("value").alias("value"))


def funnel_kpis(deals: DataFrame) -> DataFrame:
    """A-COM-25: deals by status, won share of all and of closed deals, open and won value, mean cycle of won deals
    (whole days, 0..365), forecast = open value x won share of closed deals."""
    st = F.col("status")
    days = F.floor(F.expr("timestampdiff(MICROSECOND, add_time, won_time)") / F.lit(86_400_000_000))
    n = {s: C.count_if(st == s) for s in ("open", "won", "lost")}
    g = live_deals(deals).agg(
        F.count("*").alias("deals"), *(c.alias(s) for s, c in n.items()),
        C.money(F.coalesce(F.sum(F.when(st == "open", F.col("value"))), F.lit(0))).alias("open_value"),
        C.money(F.coalesce(F.sum(F.when(st == "won", F.col("value"))), F.lit(0))).alias("won_value"),
        F.avg(F.when((st == "won") & days.between(0, 365), days)).alias("mean_cycle_days"))
    zero = F.lit(0.0)
    closed = F.coalesce(C.pct("won", F.col("won") + F.col("lost")), zero)
    return (g.withColumn("won_pct", F.coalesce(C.pct("won", "deals"), zero)).withColumn("win_rate_pct", closed)
            .withColumn("forecast", F.round(F.col("open_value").cast("double") * closed / F.lit(100.0), 4)))


def funnel_by_stage(deals: DataFrame, stages: DataFrame) -> DataFrame:
    """A-COM-25: open deals and their value per stage."""
    d = live_deals(deals).where(F.col("status") == "open").join(F.broadcast(stages.select("stage_id", "stage_name", "order_nr")), "stage_id", "left")
    return d.groupBy("order_nr", "stage_name").agg(F.count("*").alias("deals"), C.money(F.coalesce(F.sum("value"), F.lit(0))).alias("value"))


def top_owners(deals: DataFrame, users: DataFrame, n: int = 10, unnamed: str = "Sem owner") -> DataFrame:
    """A-COM-25: owners with the highest value over all of their deals (top-n report); unknown owners are one group."""
    d = live_deals(deals).select("owner_id", "value").join(users.select(F.col("user_id").alias("owner_id"), "user_name"), "owner_id", "left")
    g = d.groupBy(F.coalesce("user_name", F.lit(unnamed)).alias("user_name")).agg(
        F.count("*").alias("deals"), C.money(F.coalesce(F.sum("value"), F.lit(0))).alias("value"))
    return g.orderBy(F.col("value").desc(), F.col("user_name")).limit(n)


def top_open_deals(deals: DataFrame, stages: DataFrame, users: DataFrame, n: int = 30) -> DataFrame:
    """A-COM-25: open deals of the highest value with pipeline, stage and owner (top-n report)."""
    d = live_deals(deals).where(F.col("status") == "open").select(
        "deal_id", "pipeline_id", "org_name", "stage_id", F.col("owner_id").alias("user_id"), F.coalesce("value", F.lit(0)).alias("value"))
    top = d.orderBy(F.col("value").desc(), F.col("deal_id")).limit(n)
    j = top.join(F.broadcast(stages.select("stage_id", "stage_name")), "stage_id", "left").join(users.select("user_id", "user_name"), "user_id", "left")
    return j.select("deal_id", "pipeline_id", "org_name", "stage_name", "user_name", C.money("value").alias("value"))


def stage_stats(deals: DataFrame, stages: DataFrame) -> DataFrame:
    """A-COM-26: every stage of the list (zero-filled): deals by status, win rate, won ticket."""
    d = live_deals(deals)
    st = F.col("status")
    g = d.groupBy("stage_id").agg(F.count("*").alias("deals"), C.count_if(st == "open").alias("open"),
                                  C.count_if(st == "won").alias("won"), C.count_if(st == "lost").alias("lost"),
                                  F.sum(F.when(st == "won", F.col("value"))).alias("_wv"))
    j = stages.select("stage_id", "stage_name", "order_nr").join(g, "stage_id", "left")
    z = F.lit(0).cast("bigint")
    return j.select("stage_id", "stage_name", "order_nr",
                    *[F.coalesce(F.col(c), z).alias(c) for c in ("deals", "open", "won", "lost")],
                    C.pct(F.coalesce("won", z), F.coalesce("won", z) + F.coalesce("lost", z)).alias("win_rate_pct"),
                    C.safe_div("_wv", "won").alias("won_ticket"))


def sector_conversion(deals: DataFrame, stages: DataFrame, month: str, min_order: int = 2) -> DataFrame:
    """A-COM-27: per pipeline: deals active in the month from a minimum stage vs deals won in the month."""
    d = live_deals(deals).join(F.broadcast(stages.select("stage_id", "order_nr")), "stage_id", "left")
    m0 = F.lit(month).cast("date")
    in_month = F.trunc(F.col("add_time").cast("date"), "month") == m0
    won_month = F.trunc(F.col("won_time").cast("date"), "month") == m0
    g = d.groupBy("pipeline_id").agg(C.count_if(in_month & (F.col("order_nr") >= min_order)).alias("active"),
                                     C.count_if((F.col("status") == "won") & won_month).alias("won"))
    return g.withColumn("conversion_pct", C.pct("won", "active"))


def call_stats(calls: DataFrame) -> DataFrame:
    """A-COM-10: per user: distinct conversations, total minutes, mean minutes of a call line, positive / negative lines."""
    mood = F.lower("ai_sentiment")
    return calls.groupBy("user_key").agg(
        F.countDistinct("conversation_id").alias("conversations"),
        (F.sum("duration_seconds").cast("double") / F.lit(60.0)).alias("total_minutes"),
        (F.avg("duration_seconds") / F.lit(60.0)).alias("mean_minutes"),
        C.count_if(mood == "positive").alias("positive"), C.count_if(mood == "negative").alias("negative"))


def activities_by(activities: DataFrame, start: str, end: str, ref: str, by: str = "type", users: DataFrame | None = None,
                  exclude_users=()) -> DataFrame:
    """A-COM-32: activities done in [start, end] (by done date, else due date), and all overdue ones at ``ref``, per ``by``.

    Activities without a user are left out.  ``users`` (user_id, user_name, is_active) keeps those of active users
    and names them; names that start with one of ``exclude_users`` are left out.
    """
    when_ = F.coalesce(F.col("marked_as_done_time").cast("date"), F.col("due_date"))
    in_p = when_.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    done = F.coalesce(F.col("done"), F.lit(False))
    overdue = ~done & (F.col("due_date") < F.lit(ref).cast("date"))
    a = activities.where(F.col("user_id").isNotNull())
    keys = [by]
    if users is not None:
        u = users.where("is_active").select("user_id", "user_name")
        for p in exclude_users:
            u = u.where(~F.upper("user_name").startswith(p.upper()))
        a, keys = a.join(u, "user_id"), [by, "user_name"] if by != "user_name" else [by]
    g = a.groupBy(*keys).agg(C.count_if(done & in_p).alias("done"), C.count_if(overdue).alias("overdue"))
    return g.where((F.col("done") > 0) | (F.col("overdue") > 0))


# -- RFV panels (A-COM-14..16) ---------------------------------------------------------

def rfv_cells(score: DataFrame) -> DataFrame:
    """A-COM-14: the 25-cell matrix with client counts and revenue (empty cells zero-filled)."""
    spark = score.sparkSession
    cells = P.table(spark, P.rfv_matrix_rows(), "cell string, freq_bucket string, rec_bucket string, segment_num int, segment string")
    g = score.groupBy("cell").agg(F.countDistinct("partner_name").alias("clients"), C.money_sum("total_value").alias("revenue"))
    j = cells.join(g, "cell", "left")
    return j.select("cell", "freq_bucket", "rec_bucket", "segment_num", "segment",
                    F.coalesce("clients", F.lit(0).cast("bigint")).alias("clients"),
                    C.money(F.coalesce("revenue", F.lit(0))).alias("revenue"))


def rfv_segments(score: DataFrame) -> DataFrame:
    """A-COM-14: totals per segment with share of clients."""
    g = score.groupBy("segment_num", "segment").agg(F.countDistinct("partner_name").alias("clients"),
                                                    C.money_sum("total_value").alias("revenue"))
    tot = g.agg(F.sum("clients").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select("segment_num", "segment", "clients", "revenue",
                                                C.pct("clients", "_t").alias("clients_pct"))


KPI_SEGMENTS = {"champions": (1,), "loyal": (2,), "potential_loyal": (3,), "cannot_lose": (8,), "hibernating": (10,), "at_risk": (9, 10), "lost": (11,)}


def rfv_kpis(score: DataFrame) -> DataFrame:
    """A-COM-14: headline numbers of the RFV base, with the rows of each segment group."""
    return score.agg(F.countDistinct("partner_name").alias("clients"), C.money_sum("total_value").alias("revenue"),
                     C.safe_div(F.sum("total_value"), F.count("total_value")).alias("mean_ticket"),
                     *(C.count_if(F.col("segment_num").isin(*n)).alias(c) for c, n in KPI_SEGMENTS.items()),
                     F.max("ref_date").alias("ref_date"))


# FIXED VALUES: cells of the owner panel's segment counts
PANEL_CELLS = {"champions": ("F1R1",), "loyal": ("F1R2", "F1R3", "F2R1", "F2R2", "F2R3"), "potential_loyal": ("F3R1", "F3R2", "F4R1", "F4R2"),
               "cannot_lose": ("F1R4", "F1R5"), "at_risk": ("F2R4", "F2R5", "F3R4", "F3R5", "F4R4"), "lost": ("F4R5", "F5R4", "F5R5")}


def rfv_owner_panel(score: DataFrame) -> DataFrame:
    """A-COM-14: per owner: clients, rows per segment group (by cell), revenue and revenue per client."""
    g = score.groupBy("rfv_salesperson").agg(
        F.countDistinct("partner_name").alias("clients"), *(C.count_if(F.col("cell").isin(*cells)).alias(c) for c, cells in PANEL_CELLS.items()),
        C.money_sum("total_value").alias("revenue"))
    return g.withColumn("ticket", C.safe_div("revenue", "clients"))


def rfv_clients(score: DataFrame, segment_num: int) -> DataFrame:
    """A-COM-15: clients of one segment, most recent first, then highest value."""
    return score.where(F.col("segment_num") == segment_num).select(
        "partner_name", "rfv_familia", "rfv_salesperson", "partner_codes", "recency_days", "frequency", "total_value")


def attach_portfolio(score: DataFrame, portfolio: DataFrame) -> DataFrame:
    """A-COM-16 / JON-10: portfolio owner attached to score rows via their comma list of codes."""
    ex = score.select("partner_name", "rfv_familia", "rfv_salesperson",
                      F.explode(F.split("partner_codes", ",")).alias("code"))
    pf = portfolio.select(F.col("partner_code").cast("string").alias("code"), F.col("salesperson_name").alias("owner"),
                          F.col("rfv_familia").alias("pf_family"))
    j = ex.join(pf, "code", "left")
    return j.groupBy("partner_name", "rfv_familia", "rfv_salesperson").agg(
        F.min("owner").alias("portfolio_owner"), F.countDistinct("code").alias("codes"),
        C.count_if(F.col("owner").isNotNull()).alias("codes_in_portfolio"))


def compare_reassignment(score: DataFrame, moves: DataFrame) -> DataFrame:
    """A-COM-37: owner summary before / after moving clients (moves: partner_name, to_owner)."""
    m = moves.select("partner_name", "to_owner")
    j = score.join(m, "partner_name", "left")
    after = F.coalesce(F.col("to_owner"), F.col("rfv_salesperson"))
    b = j.groupBy(F.col("rfv_salesperson").alias("owner")).agg(F.countDistinct("partner_name").alias("clients_before"),
                                                               C.money_sum("total_value").alias("revenue_before"))
    a = j.groupBy(after.alias("owner")).agg(F.countDistinct("partner_name").alias("clients_after"),
                                            C.money_sum("total_value").alias("revenue_after"))
    o = b.join(a, "owner", "full_outer")
    z = F.lit(0)
    return o.select("owner", F.coalesce("clients_before", z.cast("bigint")).alias("clients_before"),
                    F.coalesce("clients_after", z.cast("bigint")).alias("clients_after"),
                    C.money(F.coalesce("revenue_before", z)).alias("revenue_before"),
                    C.money(F.coalesce("revenue_after", z)).alias("revenue_after"),
                    C.money(F.coalesce("revenue_after", z) - F.coalesce("revenue_before", z)).alias("revenue_impact"))


def mask_values(df: DataFrame, cols, privileged: bool = False) -> DataFrame:
    """A-COM-38: zero the money columns for non-privileged viewers (percentages untouched)."""
    if privileged:
        return df
    return df.select(*[(F.lit(0).cast(df.schema[c].dataType).alias(c) if c in cols else F.col(c)) for c in df.columns])


# segments of the panel: column -> segment numbers
PANEL_SEGMENTS = {"champions": (1,), "loyal": (2,), "potential_loyal": (3,), "cannot_lose": (8,), "at_risk": (9, 10), "lost": (11,)}
PANEL_ALERTS = {"alerts_opportunity": "flag_opportunity", "alerts_churn": "flag_silent_churn", "off_radar": "flag_off_radar"}


def salesperson_panel(c360: DataFrame, deals: DataFrame, pipelines: DataFrame, calls: DataFrame, users: DataFrame, now: str) -> DataFrame:
    """A-COM-9: per owner x family: distinct clients in total, per segment group and per alert, revenue, deals of the owner's
    CRM users in that family, and the owner's calls.

    ``pipelines``: pipeline_id, rfv_familia; ``users``: user_id, salesperson_name.  Deals and calls are reduced to one row
    per owner (and family) first, so several users of one owner, or several codes of one organisation, count once.
    """
    name = F.col("partner_name")
    g = c360.groupBy("rfv_salesperson", "rfv_familia").agg(
        F.countDistinct(name).alias("clients"),
        *(C.count_distinct_if(F.col("segment_num").isin(*nums), name).alias(c) for c, nums in PANEL_SEGMENTS.items()),
        C.money(F.coalesce(F.sum("revenue"), F.lit(0))).alias("revenue"),
        *(C.count_distinct_if(F.col(flag), name).alias(c) for c, flag in PANEL_ALERTS.items()))
    g = g.withColumn("top_pct", C.pct(F.col("champions") + F.col("loyal"), "clients")).withColumn("ticket", C.safe_div("revenue", "clients"))
    owner = users.select("user_id", F.upper("salesperson_name").alias("_owner"))
    st, val = F.col("status"), F.coalesce("value", F.lit(0))
    recent = (st == "won") & (F.col("won_time") >= _now(now) - F.make_dt_interval(F.lit(P.WON_LOOKBACK_DAYS)))
    d = (live_deals(deals).join(owner, F.col("owner_id") == F.col("user_id")).join(F.broadcast(pipelines.select("pipeline_id", "rfv_familia")), "pipeline_id")
         .groupBy("_owner", "rfv_familia").agg(
             C.count_if(st == "open").alias("deals_open"), C.count_if(st == "won").alias("deals_won"),
             C.money(F.sum(F.when(st == "open", val).otherwise(0))).alias("open_value"),
             C.money(F.sum(F.when(recent, val).otherwise(0))).alias("won_value_12m")))
    line = users.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_key"), F.upper("salesperson_name").alias("_owner"))
    cs = calls.join(line, "user_key").groupBy("_owner").agg(
        F.countDistinct("conversation_id").alias("calls"), (F.sum("duration_seconds").cast("double") / F.lit(60.0)).alias("call_minutes"),
        (F.avg("duration_seconds") / F.lit(60.0)).alias("mean_call_minutes"), C.count_if(F.lower("ai_sentiment") == "positive").alias("positive_calls"))
    cs = cs.withColumn("positive_pct", C.pct("positive_calls", "calls"))
    j = g.withColumn("_owner", F.upper("rfv_salesperson")).join(d, ["_owner", "rfv_familia"], "left").join(cs, "_owner", "left").drop("_owner")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("deals_open", "deals_won", "calls", "positive_calls")}
    zero |= {c: C.money(F.coalesce(F.col(c), F.lit(0))) for c in ("open_value", "won_value_12m")}
    zero |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("call_minutes", "mean_call_minutes")}
    return j.withColumns(zero)
