"""Column helpers: conditional aggregates, safe ratios, name normalisation, dates.

All helpers return native Spark ``Column`` expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops import params as P


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- conditional aggregates (AGG-1, AGG-2, AGG-7) -------------------------------

def count_if(cond: Column) -> Column:
    """COUNTIF as BIGINT (0 on an empty group)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column, value) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE 0 END)."""
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(0)))


def count_distinct_if(cond: Column, value) -> Column:
    return F.countDistinct(F.when(cond, col(value)))


def value_at_max(value, order) -> Column:
    """Value of ``value`` on the row with the largest ``order`` (ties -> largest value), NULLs ignored."""
    v = col(value)
    return F.max_by(v, F.when(v.isNotNull(), F.struct(col(order), v)))


# -- arithmetic (AGG-6, AGG-10) -------------------------------------------------

def safe_div(a, b) -> Column:
    """a / b as DOUBLE, NULL when b is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def pct(a, b) -> Column:
    """100 * a / b as DOUBLE, NULL on zero."""
    return F.try_divide(col(a).cast("double") * F.lit(100.0), col(b).cast("double"))


def mean_of(sum_col, n_col) -> Column:
    return safe_div(sum_col, n_col)


def money(c) -> Column:
    return col(c).cast("decimal(18,2)")


def money_sum(c) -> Column:
    """Exact decimal sum cast to DECIMAL(18,2)."""
    return F.sum(col(c)).cast("decimal(18,2)")


def money_sum0(c) -> Column:
    return F.coalesce(F.sum(col(c)), F.lit(0)).cast("decimal(18,2)")


def round_units_text(c) -> Column:
    """Number as integer text (ROUND(x, 0) rendered without '.0')."""
    return F.round(col(c), 0).cast("decimal(38,0)").cast("string")


# -- strings (PRJ-2, QLT-6) ------------------------------------------------------

def clean_string(c) -> Column:
    """Strip NUL characters, trim, and map blank-like tokens to NULL."""
    t = F.trim(F.regexp_replace(col(c), "\u0000", ""))
    return F.when(t.isin(*P.BLANK_TOKENS), F.lit(None).cast("string")).otherwise(t)


def norm_name(c) -> Column:
    """UPPER(TRIM(x))."""
    return F.upper(F.trim(col(c)))


def strip_accents(c) -> Column:
    return F.translate(col(c), P.ACCENTED, P.UNACCENTED)


def strip_accents_key(c) -> Column:
    """Accent fold + upper + keep only [A-Z0-9] (matching key)."""
    return F.regexp_replace(F.upper(strip_accents(col(c))), "[^A-Z0-9]", "")


def drop_paren_suffix(c) -> Column:
    """Remove a trailing parenthetical ``NAME (BRANCH)`` -> ``NAME``."""
    return F.trim(F.regexp_replace(col(c), r"\s*\([^)]*\)\s*$", ""))


def digits_only(c) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def title_case(c) -> Column:
    return F.initcap(F.lower(col(c)))


def tolerant_bool(c) -> Column:
    """true/1/yes/t -> TRUE, false/0/no/f -> FALSE, else NULL (case-insensitive)."""
    s = F.lower(F.trim(col(c).cast("string")))
    return F.when(s.isin(*P.TRUE_TOKENS), F.lit(True)).when(s.isin(*P.FALSE_TOKENS), F.lit(False))


# -- dates (FLT-2, AGG-13, 2.I) ---------------------------------------------------

def rolling_year_start(ref) -> Column:
    """First day of the month one year before ``ref``."""
    return F.trunc(F.add_months(F.lit(ref).cast("date"), -12), "month")


def lookback_start(ref, months: int) -> Column:
    return F.trunc(F.add_months(F.lit(ref).cast("date"), -months), "month")


def week_of_month(c) -> Column:
    return (F.floor((F.dayofmonth(col(c)) - 1) / 7) + 1).cast("int")


def week_label(c) -> Column:
    """'dd-dd' day range of the week of month, clipped at month end."""
    w = week_of_month(c)
    start = (w - 1) * 7 + 1
    end = F.least(start + 6, F.dayofmonth(F.last_day(col(c))))
    return F.format_string("%02d-%02d", start, end)


def year_month(c) -> Column:
    return F.date_format(col(c), "yyyy-MM")
