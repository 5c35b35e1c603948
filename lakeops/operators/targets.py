"""Targets, business calendars, rankings, reverse funnel, performance matrix, calendars (A-COM-28..36).

Calendars are spines generated per month with ``sequence`` + ``explode`` from
the months present in the data (a month is at most 31 rows), so no driver
list and no fixed input drives the work.  Min-max normalisation uses a 1-row
aggregate joined back (broadcast), not an unpartitioned window.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.operators import commercial as com

# FIXED VALUES: national holidays of the reference year (parameter default; deployments pass their own table).
HOLIDAYS_2001 = ["2001-01-01", "2001-02-26", "2001-02-27", "2001-04-13", "2001-04-21", "2001-05-01", "2001-06-14",
                 "2001-09-07", "2001-10-12", "2001-11-02", "2001-11-15", "2001-12-25"]


def month_days(months: DataFrame, month_col: str = "month") -> DataFrame:
    """Calendar spine: one row per day of each month in ``months``."""
    m = F.col(month_col)
    return months.select(m.alias("month"), F.explode(F.sequence(m, F.last_day(m))).alias("day"))


def with_business_flag(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """weekday Mon-Fri and not a holiday (anti-join on a small parameter table)."""
    h = F.broadcast(holidays.select(F.col("holiday").cast("date").alias("day")).withColumn("_h", F.lit(True)))
    d = days.join(h, "day", "left")
    wd = F.dayofweek("day")  # 1 = Sunday
    return d.withColumn("is_business_day", (wd >= 2) & (wd <= 6) & F.col("_h").isNull()).drop("_h")


def business_days(months: DataFrame, holidays: DataFrame, ref: str | None = None) -> DataFrame:
    """A-COM-30: per month: business days in total, elapsed up to ``ref`` (today counts), remaining (>= 1)."""
    d = with_business_flag(month_days(months), holidays)
    b = F.col("is_business_day")
    aggs = [C.count_if(b).alias("total")]
    if ref is not None:
        aggs.append(C.count_if(b & (F.col("day") <= F.lit(ref).cast("date"))).alias("elapsed"))
    g = d.groupBy("month").agg(*aggs)
    if ref is not None:
        g = g.withColumn("remaining", F.greatest(F.col("total") - F.col("elapsed"), F.lit(1)))
    return g


def weekdays_before(day: Column) -> Column:
    """Number of days from Monday to Friday before ``day``, counted from a Monday long ago."""
    n = F.datediff(day, F.lit("1800-01-06").cast("date"))  # a Monday
    week = F.floor(n / F.lit(7))
    return (week * 5 + F.least(n - week * 7, F.lit(5))).cast("long")


def busday_count(start: Column, end: Column, holidays: Sequence[str] = ()) -> Column:
    """Business days from ``start`` (included) to ``end`` (not included), for any two date columns; null if one is.

    Weekdays are counted in closed form and holidays that fall on weekdays taken off (a short fixed list, a parameter).  If ``end`` is the
    earlier one the count is negative, over the days after ``end`` up to and with ``start``.
    """
    off = sorted({d for h in holidays if (d := datetime.date.fromisoformat(h)).weekday() < 5})
    back = end < start
    a, b = F.when(back, F.date_add(end, 1)).otherwise(start), F.when(back, F.date_add(start, 1)).otherwise(end)
    days = weekdays_before(b) - weekdays_before(a)
    if off:
        days = days - F.size(F.filter(F.array(*(F.lit(d) for d in off)), lambda h: (h >= a) & (h < b)))
    return F.when(start.isNotNull() & end.isNotNull(), F.when(back, -days).otherwise(days)).cast("long")


def add_busdays(day: Column, n: Column | int, holidays: Sequence[str] = ()) -> Column:
    """The business day ``n`` business days after ``day`` (before it, if negative), for any date and integer columns; null if one is.

    A day that is no business day counts as the next one, so ``n = 0`` gives the first business day from ``day`` on.
    Business days are numbered through: weekdays in closed form, less the holidays on weekdays before them (a short fixed
    list).  The weekday with number k of those that are left is k + the number of holidays whose own number, less the
    holidays before it, is at most k; so no day is stepped through.
    """
    off = sorted({d for h in holidays if (d := datetime.date.fromisoformat(h)).weekday() < 5})
    n = n if isinstance(n, Column) else F.lit(n)
    k = weekdays_before(day) + n
    if off:
        k = k - F.size(F.filter(F.array(*(F.lit(d) for d in off)), lambda h: h < day))
        monday = datetime.date(1800, 1, 6)
        numbers = [(d - monday).days // 7 * 5 + d.weekday() - i for i, d in enumerate(off)]
        k = k + F.size(F.filter(F.array(*(F.lit(w).cast("long") for w in numbers)), lambda w: w <= k))
    week = F.floor(k / F.lit(5))
    return F.when(day.isNotNull() & n.isNotNull(), F.date_add(F.lit("1800-01-06").cast("date"), (week * 7 + k - week * 5).cast("int")))


def target_vs_actual(sales: DataFrame, targets: DataFrame, month: str) -> DataFrame:
    """A-COM-28: per view (GERAL and each channel): realised, target, % and gap for the month."""
    m = F.lit(month).cast("date")
    s = com.in_months(sales, "invoice_date", m)
    # per channel and the overall view in one aggregation (ROLLUP): one scan
    r = s.rollup(F.col("channel").alias("view_key")).agg(C.money_sum("product_amount").alias("realised"),
                                                          F.grouping_id().alias("_g"))
    real = r.select(F.when(F.col("_g") == 1, F.lit("GERAL")).otherwise(F.col("view_key")).alias("view_key"), "realised")
    t = targets.where(F.col("month") == m).select("view_key", "target")
    j = t.join(real, "view_key", "full_outer")
    r = F.coalesce("realised", F.lit(0))
    return j.select("view_key", C.money(r).alias("realised"), "target",
                    C.pct(r, "target").alias("pct"), C.money(F.col("target") - r).alias("gap"))


def rank_month(tva: DataFrame) -> DataFrame:
    """A-COM-29 / SRT-3: ranking by % of target (NULL last), then realised, then key."""
    w = Window.orderBy(F.col("pct").desc_nulls_last(), F.col("realised").desc(), F.col("view_key"))
    return tva.withColumn("position", F.row_number().over(w))  # one row per view after aggregation


def _days_of(bdays: DataFrame, month: str) -> DataFrame:
    """The month's row of the business days."""
    return bdays.where(F.col("month") == F.lit(month).cast("date")).select("total", "elapsed")


def rank_salespeople(orders: DataFrame, natures: DataFrame, deals: DataFrame, users: DataFrame, targets: DataFrame, bdays: DataFrame, month: str, day: str, *,
                     erp_month: str | None = None, groups=tuple(P.SALES_GROUPS)) -> DataFrame:
    """A-COM-29: per salesperson, invoiced in the month (ERP) beside won in the month (CRM), each against the target, with the
    month's position; and won today against the daily target (target / business days): missing, met, and the day's position.

    Everyone with invoices appears; without a target the shares are NULL and rank last.
    ``users``: user_id, salesperson_name; ``targets``: salesperson_name, target; ``bdays``: month, total.
    """
    m = F.lit(month).cast("date")
    sold = com.in_months(com.billed_orders(orders, natures, exclude_channels=(), statuses=None, groups=groups), "invoice_date", F.lit(erp_month or month).cast("date"))
    named = sold.where(F.col("salesperson_name").isNotNull() & (F.trim("salesperson_name") != ""))
    erp = named.groupBy("salesperson_name").agg(C.money_sum("product_amount").alias("realised"))
    won_day, val = F.col("won_time").cast("date"), F.coalesce("value", F.lit(0))
    d = deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False)) & (F.col("status") == "won")).join(
        users.select(F.col("user_id").alias("_uid"), "salesperson_name"), F.col("owner_id") == F.col("_uid"))
    in_month = (won_day >= m) & (won_day < F.add_months(m, 1))
    crm = d.groupBy("salesperson_name").agg(C.money(F.sum(F.when(in_month, val).otherwise(0))).alias("won_month"),
                                            C.money(F.sum(F.when(won_day == F.lit(day).cast("date"), val).otherwise(0))).alias("won_today"))
    days = bdays.where(F.col("month") == m).select(F.col("total").cast("double").alias("_days"))
    j = (erp.join(crm, "salesperson_name", "left").join(targets.where(F.col("target") > 0).select("salesperson_name", "target"), "salesperson_name", "left")
         .crossJoin(F.broadcast(days)))
    j = j.withColumns({c: C.money(F.coalesce(F.col(c), F.lit(0))) for c in ("won_month", "won_today")})
    t, today = F.col("target").cast("double"), F.col("won_today").cast("double")
    j = j.withColumn("daily_target", F.try_divide(t, F.col("_days"))).drop("_days")
    j = (j.withColumn("pct", F.try_divide(F.col("realised").cast("double"), t)).withColumn("pct_won", F.try_divide(F.col("won_month").cast("double"), t))
         .withColumn("missing_today", F.when(F.col("daily_target").isNotNull(), F.greatest(F.col("daily_target") - today, F.lit(0.0))))
         .withColumn("met_today", today >= F.col("daily_target")).withColumn("pct_today", F.try_divide(today, F.col("daily_target"))))
    # one row per person from here on
    by_month = Window.orderBy(F.col("pct").desc_nulls_last(), F.col("realised").desc(), F.col("salesperson_name"))
    by_day = Window.orderBy(F.col("pct_today").desc_nulls_last(), F.col("salesperson_name"))
    return j.withColumn("position", F.row_number().over(by_month)).withColumn("position_today", F.row_number().over(by_day))


def needed_per_day(tva: DataFrame, bdays: DataFrame, month: str) -> DataFrame:
    """A-COM-29: expected realised so far and the sale needed per remaining business day."""
    b = _days_of(bdays, month)
    j = tva.crossJoin(F.broadcast(b))
    exp = F.try_divide(F.col("target").cast("double"), F.col("total").cast("double")) * F.col("elapsed").cast("double")
    need = (F.greatest(F.col("target") - F.col("realised"), F.lit(0)).cast("double")
            / F.greatest(F.col("total") - F.col("elapsed") + 1, F.lit(1)).cast("double"))
    return j.select("view_key", "target", "realised", exp.alias("expected"), need.alias("needed_per_day"))


def won_by_owner(deals: DataFrame, users: DataFrame, month: str, day: str) -> DataFrame:
    """A-COM-28: won value per owner in the month and on the day."""
    d = deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False)) & (F.col("status") == "won"))
    wd = F.col("won_time").cast("date")
    g = d.groupBy(F.col("owner_id").alias("user_id")).agg(
        C.money(F.coalesce(F.sum(F.when(F.trunc(wd, "month") == F.lit(month).cast("date"), F.col("value"))), F.lit(0))).alias("won_month"),
        C.money(F.coalesce(F.sum(F.when(wd == F.lit(day).cast("date"), F.col("value"))), F.lit(0))).alias("won_day"))
    return g.join(users.select("user_id", "user_name"), "user_id", "left")


def owner_rates(deals: DataFrame) -> DataFrame:
    """Conversion rates per owner from the CRM: ticket and the stage-to-stage rates used by the reverse funnel."""
    d = deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False)))
    st, sg = F.col("status"), F.col("stage_id")
    n = F.count("*")
    return d.groupBy(F.col("owner_id").alias("user_id")).agg(
        C.safe_div(F.sum(F.when(st == "won", F.col("value"))), C.count_if(st == "won")).alias("ticket"),
        C.safe_div(C.count_if(st == "won"), C.count_if(st.isin("won", "lost"))).alias("close_rate"),
        C.safe_div(C.count_if(sg >= 4), n).alias("negotiation_rate"),
        C.safe_div(C.count_if(sg >= 3), n).alias("quote_rate"),
        C.safe_div(C.count_if(sg >= 2), n).alias("connection_rate"),
        C.safe_div(C.count_if(sg >= 1), n).alias("contact_rate"),
        C.money(F.coalesce(F.sum(F.when(st == "won", F.col("value"))), F.lit(0))).alias("won"))


RATE_CHAIN = ["close_rate", "negotiation_rate", "quote_rate", "connection_rate", "contact_rate"]
FUNNEL_STEPS = ["closings", "negotiations", "quotes", "connections", "contacts"]


def reverse_funnel(rates: DataFrame, targets: DataFrame, business_days: int = 22) -> DataFrame:
    """A-COM-31: remaining target -> sales -> closings -> negotiations -> quotes -> connections -> contacts, per month and per business day.

    Missing owner rates fall back to the mean over owners; a zero or missing rate yields 0.
    """
    means = rates.agg(*[F.avg(c).alias(f"_m_{c}") for c in ["ticket"] + RATE_CHAIN])
    j = rates.join(targets.select("user_id", "target"), "user_id").crossJoin(F.broadcast(means))
    for c in ["ticket"] + RATE_CHAIN:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    remaining = F.greatest(F.col("target") - F.col("won"), F.lit(0)).cast("double")
    j = j.withColumn("remaining", remaining)
    cur = F.coalesce(F.try_divide(F.col("remaining"), F.col("ticket")), F.lit(0.0))
    j = j.withColumn("sales", cur)
    prev = "sales"
    for rate, step in zip(RATE_CHAIN, FUNNEL_STEPS):
        j = j.withColumn(step, F.coalesce(F.try_divide(F.col(prev), F.col(rate)), F.lit(0.0)))
        prev = step
    per_day = F.coalesce(F.try_divide(F.col("contacts"), F.lit(float(business_days))), F.lit(0.0))
    return j.select("user_id", "target", "won", "remaining", "ticket", *RATE_CHAIN, "sales", *FUNNEL_STEPS, per_day.alias("contacts_per_day"))


def reverse_funnel_families(funnel: DataFrame, families: DataFrame) -> DataFrame:
    """A-COM-31: totals per family (``families``: user_id, rfv_familia): what is left to sell, the steps that takes, and the rates between them."""
    g = funnel.join(families.select("user_id", "rfv_familia"), "user_id").groupBy("rfv_familia").agg(
        *(F.round(F.sum(c), 6).alias(c) for c in ("remaining", "sales", "quotes", "contacts", "contacts_per_day")), F.count("*").alias("people"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return g.withColumns({"ticket": ratio("remaining", "sales"), "sales_per_quote": ratio("sales", "quotes"), "quotes_per_contact": ratio("quotes", "contacts")})


def mean_term(orders: DataFrame) -> DataFrame:
    """A-COM-33: value-weighted mean payment term per salesperson x invoice month."""
    o = orders.where(F.col("invoice_date").isNotNull())
    return o.groupBy("salesperson_name", F.trunc("invoice_date", "month").alias("month")).agg(
        C.safe_div(F.sum(F.col("payment_term_days") * F.col("product_amount")), F.sum("product_amount")).alias("mean_term_days"),
        C.money_sum("product_amount").alias("value"))


def minmax_score(df: DataFrame, cols: list[str], invert: list[str] = (), scale: float = 100.0) -> DataFrame:
    """WIN-10: each column normalised to 0..100 within the frame (all equal -> 50), optional inversion."""
    mm = df.agg(*[F.min(c).alias(f"_mn_{c}") for c in cols], *[F.max(c).alias(f"_mx_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(mm))
    for c in cols:
        lo, hi, v = F.col(f"_mn_{c}").cast("double"), F.col(f"_mx_{c}").cast("double"), F.col(c).cast("double")
        s = F.when(v.isNull(), F.lit(None).cast("double")).when(hi == lo, F.lit(scale / 2)).otherwise((v - lo) / (hi - lo) * F.lit(scale))
        if c in invert:
            s = F.when(s.isNull(), s).otherwise(F.lit(scale) - s)
        j = j.withColumn(f"score_{c}", s)
    return j.drop(*[f"_mn_{c}" for c in cols], *[f"_mx_{c}" for c in cols])


EFFORT = ["calls", "meetings", "proposals", "follow_ups", "activities", "opportunities", "cycle_days"]
RESULT = ["realised", "contracted", "attainment", "pipeline", "win_rate", "ticket"]


# FIXED VALUES: activity types of the effort indicators
ACTIVITY_KINDS = {"calls": ["call"], "meetings": ["meeting"], "proposals": ["envio_de_orcamento"], "follow_ups": ["tentativa_de_contato", "contato"]}


def performance_indicators(deals: DataFrame, activities: DataFrame, orders: DataFrame, natures: DataFrame, users: DataFrame, targets: DataFrame,
                           month: str, *, erp_month: str | None = None, kinds: dict[str, list[str]] | None = None, groups=tuple(P.SALES_GROUPS)) -> DataFrame:
    """A-COM-34: the month's indicators of each seller with a target.

    Effort: done activities by kind, all registered ones (by due date), deals created, mean days to close of deals
    closed in the month.  Result: invoiced revenue and orders of the sales groups (ERP), value contracted (deals won in the
    month), share of the target reached (150 % at most), value of deals created, won share of deals closed, revenue per order.
    ``users``: user_id, salesperson_name (active users of the CRM); ``targets``: salesperson_name, target.
    """
    m = F.lit(month).cast("date")
    end = F.add_months(m, 1)
    kinds = kinds or ACTIVITY_KINDS

    def within(day):
        return F.coalesce((day >= m) & (day < end), F.lit(False))

    who = users.select(F.col("user_id").alias("_uid"), "salesperson_name")
    done = F.coalesce("done", F.lit(False))
    a = com.date_range(activities, "due_date", (m, end)).join(who, F.col("user_id") == F.col("_uid"))
    aa = a.groupBy("salesperson_name").agg(*(C.count_if(F.col("type").isin(*v) & done).alias(k) for k, v in kinds.items()), F.count("*").alias("activities"))
    won_day, lost_day, born = (F.col(c).cast("date") for c in ("won_time", "lost_time", "add_time"))
    st, val = F.col("status"), F.coalesce("value", F.lit(0))
    won, lost = (st == "won") & within(won_day), (st == "lost") & within(lost_day)
    closed = st.isin("won", "lost") & within(F.coalesce(won_day, lost_day))
    d = deals.where(~F.coalesce(F.col("is_deleted"), F.lit(False))).join(who, F.col("owner_id") == F.col("_uid"))
    dd = d.groupBy("salesperson_name").agg(
        C.count_if(within(born)).alias("opportunities"), C.money(F.sum(F.when(within(born), val).otherwise(0))).alias("pipeline"),
        C.count_if(won).alias("_won"), C.count_if(lost).alias("_lost"), C.money(F.sum(F.when(won, val).otherwise(0))).alias("contracted"),
        F.avg(F.when(closed, F.datediff(F.coalesce(won_day, lost_day), born))).alias("cycle_days"))
    erp = com.in_months(com.billed_orders(orders, natures, exclude_channels=(), statuses=None, groups=groups), "invoice_date", F.lit(erp_month or month).cast("date"))
    ee = erp.groupBy("salesperson_name").agg(C.money_sum("product_amount").alias("realised"), F.count("*").alias("_orders"))
    j = (targets.where(F.col("target") > 0).select("salesperson_name", "target").join(aa, "salesperson_name", "left")
         .join(dd, "salesperson_name", "left").join(ee, "salesperson_name", "left"))
    counts = [*kinds, "activities", "opportunities", "_won", "_lost", "_orders"]
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts} | {c: C.money(F.coalesce(F.col(c), F.lit(0))) for c in ("pipeline", "contracted", "realised")})
    real = F.col("realised").cast("double")
    return j.select("salesperson_name", "target", *kinds, "activities", "opportunities", "cycle_days", "realised", "contracted",
                    (F.least(real / F.col("target").cast("double"), F.lit(1.5)) * F.lit(100.0)).alias("attainment"), "pipeline",
                    F.coalesce(C.pct("_won", F.col("_won") + F.col("_lost")), F.lit(0.0)).alias("win_rate"),
                    F.coalesce(F.try_divide(real, F.col("_orders").cast("double")), F.lit(0.0)).alias("ticket"))


def performance_matrix(indicators: DataFrame) -> DataFrame:
    """A-COM-34: min-max scores of effort and result indicators (cycle inverted, left out where there is none), their means
    and the quadrant at 50."""
    s = minmax_score(indicators, EFFORT + RESULT, invert=["cycle_days"])
    eff = [F.col(f"score_{c}") for c in EFFORT]
    res = [F.col(f"score_{c}") for c in RESULT]

    def mean_of(cs):
        num = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
        den = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
        return F.try_divide(num, den.cast("double"))

    s = s.withColumn("effort_score", mean_of(eff)).withColumn("result_score", mean_of(res))
    high_e, high_r = F.col("effort_score") >= 50, F.col("result_score") >= 50
    return s.withColumn("quadrant", F.when(high_e & high_r, "Alta Performance").when(high_r, "Futuro Talento")
                        .when(high_e, "Esforço Ineficiente").otherwise("Baixa Entrega"))


def _target_value(target: DataFrame) -> DataFrame:
    """One row: the target, NULL if there is none or it is not positive."""
    return target.agg(F.max("target").cast("double").alias("_t")).select(F.when(F.col("_t") > 0, F.col("_t")).alias("_t"))


def sales_calendar(orders: DataFrame, natures: DataFrame, holidays: DataFrame, month: str, target: DataFrame) -> DataFrame:
    """A-COM-35: days of the month on a Sunday-first week grid: sales by order date, the week's total, and whether the
    day reached the daily target (target / business days, the same for every day; NULL without a target)."""
    m = F.lit(month).cast("date")
    sales = com.in_months(com.billed_orders(orders, natures, exclude_channels=(), statuses=None, date_col="order_date"), "order_date", m)
    rev = sales.groupBy(F.col("order_date").alias("day")).agg(C.money_sum("product_amount").alias("revenue"))
    one = target.sparkSession.range(1).select(m.alias("month"))
    days = with_business_flag(month_days(one), holidays)
    goal = days.agg(C.count_if(F.col("is_business_day")).cast("double").alias("_bd")).crossJoin(_target_value(target)).select(
        F.try_divide("_t", "_bd").alias("daily_target"))
    week = F.floor((F.dayofmonth("day") + F.dayofweek(F.trunc("day", "month")) - 2) / 7).cast("int") + 1
    out = days.join(rev, "day", "left").crossJoin(F.broadcast(goal)).select(
        "day", week.alias("week"), (F.dayofweek("day") - 1).alias("weekday"), "is_business_day",
        C.money(F.coalesce("revenue", F.lit(0))).alias("revenue"), "daily_target")
    # at most 31 rows
    out = out.withColumn("week_total", C.money(F.sum("revenue").over(Window.partitionBy("week"))))
    return out.withColumn("hit", F.col("revenue").cast("double") >= F.col("daily_target"))


def sales_calendar_totals(orders: DataFrame, natures: DataFrame, holidays: DataFrame, month: str, target: DataFrame,
                          ref: str | None = None) -> DataFrame:
    """A-COM-35: one row for the month: sold (order date) and invoiced, both projected at the pace of the business days so
    far, the target, its share reached, and what is left in total and per business day after ``ref``.

    Without ``ref`` the month is closed: no target, no days left, and the projections are what was reached.
    """
    m = F.lit(month).cast("date")

    def total(date_col):
        base = com.billed_orders(orders, natures, exclude_channels=(), statuses=None, date_col=date_col)
        return com.in_months(base, date_col, m).agg(C.money(F.coalesce(F.sum("product_amount"), F.lit(0))).alias("v"))

    one = target.sparkSession.range(1).select(m.alias("month"))
    days = with_business_flag(month_days(one), holidays)
    upto = F.lit(ref).cast("date") if ref else F.last_day(m)
    b = F.col("is_business_day")
    n = days.agg(C.count_if(b).alias("business_days"), C.count_if(b & (F.col("day") <= upto)).alias("elapsed"))
    goal = _target_value(target) if ref else target.sparkSession.range(1).select(F.lit(None).cast("double").alias("_t"))
    j = (total("order_date").withColumnRenamed("v", "sold").crossJoin(total("invoice_date").withColumnRenamed("v", "invoiced"))
         .crossJoin(n).crossJoin(goal))
    t = F.coalesce("_t", F.lit(0.0))

    def projected(c):
        pace = F.col(c).cast("double") / F.col("elapsed") * F.col("business_days")
        return F.when(F.lit(ref is not None) & (F.col("elapsed") > 0), pace).otherwise(F.col(c).cast("double"))

    left = F.greatest(F.col("business_days") - F.col("elapsed"), F.lit(0)) if ref else F.lit(0).cast("bigint")
    rest = F.greatest(t - F.col("sold").cast("double"), F.lit(0.0))
    return j.select("sold", "invoiced", "business_days", "elapsed", t.alias("target"),
                    F.coalesce(F.try_divide(t, F.col("business_days").cast("double")), F.lit(0.0)).alias("daily_target"),
                    F.coalesce(F.try_divide(F.col("sold").cast("double"), t), F.lit(0.0)).alias("reached"),
                    left.alias("days_left"), rest.alias("remaining"), F.coalesce(F.try_divide(rest, left.cast("double")), F.lit(0.0)).alias("remaining_per_day"),
                    projected("sold").alias("projection"), projected("invoiced").alias("invoiced_projection"))


def revenue_matrix(sales: DataFrame, years: list[int], ref: str) -> DataFrame:
    """A-COM-36: all twelve months of each year: revenue, cumulative, change on the year before of the month, the cumulative
    and the whole year (ratios, NULL where the year before is 0), the year's total, and whether the month lies after ``ref``.

    The year before the first is read too.  A year whose predecessor has no positive month has no monthly changes.
    """
    first, last = min(years) - 1, max(years)
    read = com.date_range(sales, "invoice_date", (F.lit(f"{first}-01-01").cast("date"), F.lit(f"{last + 1}-01-01").cast("date")))
    g = read.groupBy(F.year("invoice_date").alias("year"), F.month("invoice_date").alias("month")).agg(C.money_sum("product_amount").alias("r"))
    spine = sales.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year")).select(
        "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    # 12 rows a year from here on
    m = spine.join(F.broadcast(g), ["year", "month"], "left").withColumn("revenue", C.money(F.coalesce("r", F.lit(0)))).drop("r")
    in_year = Window.partitionBy("year")
    m = m.withColumn("cumulative", C.money(F.sum("revenue").over(in_year.orderBy("month").rowsBetween(Window.unboundedPreceding, 0))))
    m = m.withColumn("year_total", C.money(F.sum("revenue").over(in_year))).withColumn("_any", F.max(F.col("revenue") > 0).over(in_year))
    prev = m.select((F.col("year") + 1).alias("year"), "month", F.col("revenue").alias("_r"), F.col("cumulative").alias("_c"),
                    F.col("year_total").alias("_y"), F.col("_any").alias("has_yoy"))
    j = m.join(prev, ["year", "month"]).where(F.col("year").isin(*years))

    def yoy(cur, old):
        return F.try_divide(F.col(cur).cast("double"), F.col(old).cast("double")) - F.lit(1.0)

    r = F.lit(ref).cast("date")
    future = (F.col("year") > F.year(r)) | ((F.col("year") == F.year(r)) & (F.col("month") > F.month(r)))
    return j.select("year", "month", "revenue", "cumulative", "year_total", "has_yoy", F.when(F.col("has_yoy"), yoy("revenue", "_r")).alias("yoy_month"),
                    F.when(F.col("has_yoy"), yoy("cumulative", "_c")).alias("yoy_cumulative"), yoy("year_total", "_y").alias("yoy_total"), future.alias("future"))


def rank_day(won: DataFrame, targets: DataFrame, bdays: DataFrame, month: str) -> DataFrame:
    """A-COM-29: strict daily ranking (won today vs target / business days) and carry-over ranking
    (month-to-date vs the pro-rata target), NULLs last; one row per person after aggregation."""
    b = _days_of(bdays, month)
    j = won.join(targets.select("user_id", "target"), "user_id").crossJoin(F.broadcast(b))
    t = F.col("target").cast("double")
    day_t = F.try_divide(t, F.col("total").cast("double"))
    expected = day_t * F.col("elapsed").cast("double")
    j = j.withColumn("pct_day", F.try_divide(F.col("won_day").cast("double") * F.lit(100.0), day_t)) \
         .withColumn("pct_carry", F.try_divide(F.col("won_month").cast("double") * F.lit(100.0), expected))
    w1 = Window.orderBy(F.col("pct_day").desc_nulls_last(), F.col("won_day").desc(), F.col("user_id"))
    w2 = Window.orderBy(F.col("pct_carry").desc_nulls_last(), F.col("won_month").desc(), F.col("user_id"))
    return j.select("user_id", "target", "won_day", "won_month", "pct_day", "pct_carry").withColumn(
        "rank_day", F.row_number().over(w1)).withColumn("rank_carry", F.row_number().over(w2))
