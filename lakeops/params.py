"""Business parameters.

Every business constant the operators use lives here as plain data and is
passed into operators as an argument (operators have defaults pointing here),
so a deployment can swap a table without touching code.  Helpers at the end
turn a parameter list into a Spark ``Column`` expression (CASE / map lookup)
or into a tiny ``DataFrame`` for a broadcast join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source system's business rules)
# ---------------------------------------------------------------------------

# salesperson group code -> RFV family
GROUP_FAMILY = [("FR", "FARMACIAS"), ("FA", "HOSPITALAR"), ("PC", "HOSPITALAR")]

# Families used for sales without a portfolio owner (hybrid assignment), and that owner label.
NEW_CLIENT_FAMILY = [("FA", "NOVOS_HOSPITALAR"), ("PC", "NOVOS_HOSPITALAR"), ("FR", "NOVOS_FARMACIAS")]
NEW_CLIENT_OWNER = "Novos Clientes"

# Frequency bands (minimum distinct orders, bucket), tested top-down; else F5.
# A family whose name contains PHARMACY_MARKER uses the pharmacy bands.
PHARMACY_MARKER = "FARMACIA"
FREQ_BANDS_DEFAULT = [(5, "F1"), (4, "F2"), (3, "F3"), (2, "F4")]
FREQ_BANDS_PHARMACY = [(7, "F1"), (5, "F2"), (3, "F3"), (2, "F4")]
FREQ_FALLBACK = "F5"

# Recency bands (maximum days inclusive, bucket), tested top-down; else R5.
REC_BANDS = [(30, "R1"), (60, "R2"), (120, "R3"), (180, "R4")]
REC_FALLBACK = "R5"

# RFV matrix: frequency bucket -> segment number for R1..R5.
RFV_MATRIX = {
    "F1": [1, 2, 2, 8, 8],
    "F2": [2, 2, 2, 9, 9],
    "F3": [3, 3, 6, 9, 9],
    "F4": [3, 3, 7, 10, 11],
    "F5": [4, 5, 7, 11, 11],
}
SEGMENT_UNKNOWN = 99
SEGMENT_UNKNOWN_LABEL = "Outros"
SEGMENT_LABELS = {
    1: "Campeões",
    2: "Fiéis",
    3: "Fiéis em potencial",
    4: "Novos clientes",
    5: "Promessas",
    6: "Precisando de atenção",
    7: "Quase dormentes",
    8: "Não pode perder",
    9: "Em risco",
    10: "Hibernando",
    11: "Perdidos",
}
NO_RFV_LABEL = "SEM RFV"

# Customer-360 flags.
FLAG_OPPORTUNITY_SEGMENTS = [1, 2, 8]
FLAG_CHURN_SEGMENTS = [9, 10]
FLAG_CHURN_SILENT_DAYS = 60
FLAG_REACTIVATION_SEGMENT = 11
FLAG_REACTIVATION_MIN_VALUE = 50000
WON_LOOKBACK_DAYS = 365

# Alerts: (type, priority, message template).  Placeholders are filled from
# the customer-360 row: {seg} segment label, {rev} revenue rounded to units,
# {days} days without a CRM deal (999 when none), {open} open deals,
# {pipe} open pipeline rounded to units.
ALERTS = [
    ("OPORTUNIDADE_SEM_CRM", 1,
     "Cliente {seg} sem deal ativo no Pipedrive. Faturamento ERP: R$ {rev} — salesperson deveria estar trabalhando este cliente ativamente."),
    ("CHURN_SILENCIOSO", 2,
     "Cliente {seg} sem deal e sem contato CRM há {days} dias. Faturamento acumulado: R$ {rev} — risco de perda sem ação imediata."),
    ("RECUPERACAO_ANDAMENTO", 3,
     "Cliente {seg} em recuperação: {open} deal(s) aberto(s) | Pipeline: R$ {pipe}."),
    ("REATIVACAO_ALTO_VALOR", 4,
     "Cliente PERDIDO com faturamento histórico R$ {rev} — alto potencial de reativação."),
    ("FORA_DO_RADAR_CRM", 5,
     "Cliente ativo no ERP (R$ {rev}) sem correspondência no Pipedrive — invisível para o CRM."),
]

# Sales channel by salesperson group code (NULL -> marketplace); else "Outros".
CHANNEL_BY_GROUP = [("FA", "Hospitalar"), ("FR", "Farmácias"), ("PC", "SAC"), ("EC", "Marketplace")]
CHANNEL_NULL_GROUP = "Marketplace"
CHANNEL_OTHER = "Outros"
CHANNEL_ORDER = ["Hospitalar", "Marketplace", "Farmácias", "SAC", "Outros"]

# Marketplace / price channel by channel code; else the default label.
PRICE_CHANNEL = [
    ("92", "Mercado Livre"),
    ("AM", "Amazon"),
    ("SH", "Shopee"), ("SHOPEE", "Shopee"),
    ("LI", "Outros Marketplaces"), ("OL", "Outros Marketplaces"), ("90", "Outros Marketplaces"),
    ("91", "Outros Marketplaces"), ("AME", "Outros Marketplaces"),
]
PRICE_CHANNEL_DEFAULT = "Distribuidor/Interno"
EXCLUDED_CHANNELS = ["000054"]
BILLED_STATUSES = [3, 4]
BLANK_STATE_LABEL = "N/I"

# P&L group display order; anything else 99.
PNL_ORDER = [
    ("FATURAMENTO", 1),
    ("IMPOSTOS S/ VENDAS", 2),
    ("CUSTOS VARIÁVEIS DIRETOS", 3),
    ("DESPESAS FIXAS", 5),
    ("DESPESAS COMERCIAIS", 6),
    ("MARKETING", 7),
    ("INVESTIMENTOS", 9),
    ("MOVIMENTACAO INTRAGRUPO", 10),
    ("FORA DO P&L", 11),
    ("ATIVIDADES FINANCEIRAS", 12),
]
PNL_ORDER_DEFAULT = 99

# ABC curve classes (cumulative % upper bounds) and concentration share.
ABC_BOUNDS = [(80, "A"), (95, "B")]
ABC_FALLBACK = "C"
ABC_TOP_SHARE = 0.20

# Quotes.
QUOTE_WINDOW_DAYS = 365
QUOTE_LIVE_DAYS = 90
QUOTE_STALLED_DAYS = 180

# QA cascade traffic light on |delta %|.
# City names: least similarity of a fuzzy match up to a length, and beyond the last one.
CITY_MIN_SCORES = [(6, 70.0), (12, 80.0)]
CITY_MIN_SCORE_LONG = 85.0
# Sales groups whose invoices count for a person's ranking and result.
SALES_GROUPS = ["FA", "FR", "PC"]
QA_BANDS = [(1.0, "VERDE"), (3.0, "AMARELO")]
QA_FALLBACK = "VERMELHO"
QA_SCOPE_ORDER = ["GERAL", "HOSPITALAR", "FARMACIAS", "SAC"]

# Freshness: green <= threshold, amber <= 2 x threshold, else red.
FRESH_GREEN, FRESH_AMBER, FRESH_RED, FRESH_NONE = "green", "amber", "red", "sem leitura"

# Overdue share bands for open ledgers (% of value overdue).
OVERDUE_DANGER_PCT = 15
OVERDUE_WARNING_PCT = 5

# Entity resolution defaults.
FUZZY_THRESHOLD = 88
FUZZY_MIN_LENGTH = 15
FUZZY_REVIEW_BELOW = 92
TAX_ID_COMPANY_LENGTH = 14
CRM_TAX_ID_MIN_DIGITS = 11

# BOM explosion depth bound and path separator.
BOM_MAX_DEPTH = 10
BOM_PATH_SEP = " > "

# Accent folding table (accented -> plain), used where Spark lacks NORMALIZE().
ACCENTED = "ÁÀÂÃÄÅáàâãäåÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÕÖóòôõöÚÙÛÜúùûüÇçÑñÝýÿ"
UNACCENTED = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCcNnYyy"

# Blank-like string tokens that mean NULL.
BLANK_TOKENS = ["", "None", "nan", "NaN"]
# Tokens that mean TRUE in tolerant boolean coercion.
TRUE_TOKENS = ["true", "1", "yes", "t"]
FALSE_TOKENS = ["false", "0", "no", "f"]


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------


def case_lookup(col: Column, pairs, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END`` from a parameter list."""
    expr = None
    for k, v in pairs:
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def bands(col: Column, bounds, fallback, op="<=") -> Column:
    """First band whose bound satisfies ``col <op> bound`` (bounds tested in order)."""
    expr = None
    for bound, label in bounds:
        cond = (col <= F.lit(bound)) if op == "<=" else (col >= F.lit(bound)) if op == ">=" else (col < F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fallback))


def table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small parameter table (fixed size, safe to broadcast)."""
    return spark.createDataFrame(list(rows), schema)


def rfv_matrix_rows():
    """(cell, freq_bucket, rec_bucket, segment_num, segment) rows of the 25-cell matrix."""
    out = []
    for f, nums in RFV_MATRIX.items():
        for i, n in enumerate(nums):
            r = f"R{i + 1}"
            out.append((f + r, f, r, n, SEGMENT_LABELS[n]))
    return out
