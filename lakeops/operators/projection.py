"""Projections: schema-driven typing, string cleansing, keys, audit stamps, JSON envelopes,
PII removal, typed projection by JSON path, custom-field flattening, mail headers.

All native Column expressions; JSON is handled with ``to_json`` / ``from_json`` /
``get_json_object``.  The only driver-side work is building expressions from a
small spec (column lists, slugs).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import columns as C
from lakeops.session import cut_lineage


# -- PRJ-1 / PRJ-2 ---------------------------------------------------------------

def typed(c: Column, typ: str) -> Column:
    """Tolerant cast: invalid -> NULL.  Booleans use the true/1/yes/t rule, NULL stays NULL."""
    t = typ.lower()
    if t in ("boolean", "bool"):
        return C.tolerant_bool(c)
    if t == "date":
        return F.coalesce(F.try_to_date(F.trim(c.cast("string")), "yyyy-MM-dd"), c.try_cast("date"))
    if t in ("timestamp", "timestamp_ntz"):
        return F.trim(c.cast("string")).try_cast("timestamp_ntz")
    if t == "string":
        return C.clean_string(c)
    return F.trim(c.cast("string")).try_cast(t)


def cast_to_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """PRJ-1: select the schema's columns in order, typed; missing columns become typed NULLs."""
    cols = []
    for name, typ in schema.items():
        src = F.col(name) if name in df.columns else F.lit(None)
        cols.append(typed(src, typ).alias(name) if name in df.columns else src.cast(typ).alias(name))
    return df.select(*cols)


def clean_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-2: strip NULs, trim, blank-like tokens -> NULL, on the given (default: all string) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[C.clean_string(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# -- PRJ-4 / PRJ-5 / PRJ-6 / PRJ-7 ------------------------------------------------------

def add_snapshot_date(df: DataFrame, ref) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(ref).cast("date"))


def add_audit(df: DataFrame, ts, updated: bool = False) -> DataFrame:
    out = df.withColumn("loaded_at", F.lit(ts).cast("timestamp_ntz"))
    return out.withColumn("updated_at", F.lit(ts).cast("timestamp_ntz")) if updated else out


def add_seq_key(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """PRJ-6: consecutive 1..N key in ``order_by`` order without a single-partition window; keys of any sortable type.

    Rows are dealt into ranges of the whole order (so one value of the first column may span ranges), sorted, and
    written to the checkpoint folder once with their place in the range; each range's offset is the size of
    those before it (one row per range).  The numbering is read from what was written, so a lost executor changes no key.
    """
    place = F.monotonically_increasing_id()
    ranged = cut_lineage(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
                         .withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    offs = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_off"))
    return ranged.join(F.broadcast(offs), "_range").select(*df.columns, (F.col("_off") + F.col("_place") + F.lit(1)).alias(name))


def running_totals(df: DataFrame, value: str, order_by: Sequence, *, total: str = "running", position: str | None = "position",
                   overall: str | None = None) -> DataFrame:
    """WIN-6 / WIN-9: running total of a number over all rows in ``order_by`` order, without a single-partition window.

    Adds the total up to and with each row, the row's place from 1 on (``position``), and the sum of all rows (``overall``).
    Null values add nothing; the total is null before the first value, as in a window.  Rows that ``order_by`` does not
    tell apart come in any order, fixed once written, and are spread over ranges, so no tie fills one task.  Decimals are summed exactly; a
    fractional type is summed as double.

    Rows are dealt into ranges of the order and written once with their place; each range's sum and size (one row per
    range) are accumulated and joined back; inside a range a window adds up to its end.
    """
    place = F.monotonically_increasing_id()
    order = [c if isinstance(c, Column) else F.col(c) for c in order_by]
    ranged = cut_lineage(df.withColumn("_tie", F.rand(1)).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
                         .withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.sum("_sum").over(before).alias("_off"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
                          F.sum("_sum").over(Window.partitionBy(F.lit(1))).alias("_all"))
    inside = F.sum(value).over(Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    out = ranged.withColumn("_in", inside).join(F.broadcast(offsets), "_range").withColumn("_in", F.coalesce(F.col("_in") + F.col("_off"), F.col("_in"), F.col("_off")))
    extra = [F.col("_in").alias(total)]
    extra += [(F.col("_first") + F.col("_place") + F.lit(1)).alias(position)] if position else []
    extra += [F.col("_all").alias(overall)] if overall else []
    return out.select(*df.columns, *extra)


NULL_SENTINEL = "\u0000"
KEY_SEP = "\u001f"


def hash_key(cols: Sequence[str], integer_cols: Sequence[str] = ()) -> Column:
    """PRJ-7: stable BIGINT key of the natural key: parts joined by U+001F, NULL as U+0000,
    numbers rendered as integers, first 15 hex digits of the MD5."""
    parts = []
    for c in cols:
        v = F.col(c)
        s = v.cast("decimal(38,0)").cast("string") if c in integer_cols else v.cast("string")
        parts.append(F.coalesce(s, F.lit(NULL_SENTINEL)))
    return F.conv(F.substring(F.md5(F.concat_ws(KEY_SEP, *parts)), 1, 15), 16, 10).cast("bigint")


def add_hash_key(df: DataFrame, name: str, natural_key: Sequence[str], integer_cols: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(name, hash_key(natural_key, integer_cols))


# -- PRJ-8 / PRJ-9 / PRJ-10 ------------------------------------------------------------

def to_envelope(df: DataFrame, source: str, run_id: str, loaded_at, id_col: str, event_col: str | None,
                extras: dict[str, Column] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """PRJ-8: envelope row: run id, load time, source, extras, record id, event time, payload JSON.

    The payload has its keys sorted and the PII columns ``drop`` removed (PRJ-9).
    """
    keep = sorted(c for c in df.columns if c not in set(drop))
    payload = F.to_json(F.struct(*[F.col(c) for c in keep]))
    cols = [F.lit(run_id).alias("run_id"), F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
            F.lit(source).alias("source")]
    cols += [v.alias(k) for k, v in (extras or {}).items()]
    cols += [F.col(id_col).cast("string").alias("record_id"),
             (F.col(event_col).cast("timestamp_ntz") if event_col else F.lit(None).cast("timestamp_ntz")).alias("record_event_at"),
             payload.alias("payload_json")]
    return df.select(*cols)


def drop_pii(df: DataFrame, struct_col: str, drop: Sequence[str] = (), drop_in: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """PRJ-9: drop top-level fields of a struct column and sub-fields of nested structs."""
    c = F.col(struct_col)
    names = [f.name for f in df.schema[struct_col].dataType.fields]
    present = [d for d in drop if d in names]
    if present:
        c = c.dropFields(*present)
    for parent, subs in (drop_in or {}).items():
        c = c.withField(parent, F.col(f"{struct_col}.{parent}").dropFields(*subs))
    return df.withColumn(struct_col, c)


def project_typed(df: DataFrame, payload_col: str, columns: Sequence[tuple[str, str, str]],
                  context: dict[str, str] | None = None) -> DataFrame:
    """PRJ-10: typed columns by JSON path (``$.a.b``) or ``$context.key`` with tolerant coercion.

    ``columns`` = [(name, path, type)]; type ``list`` joins an array with ', '.
    """
    out = []
    for name, path, typ in columns:
        if path.startswith("$context."):
            v = F.lit((context or {}).get(path[len("$context."):]))
        elif typ == "list":
            v = F.array_join(F.from_json(F.get_json_object(payload_col, path), "array<string>"), ", ")
            out.append(v.alias(name))
            continue
        else:
            v = F.get_json_object(payload_col, path)
        out.append(typed(v, typ).alias(name))
    return df.select(*[c for c in df.columns], *out)


# -- PRJ-11 / PRJ-12 / PRJ-13 ------------------------------------------------------------

def slug(label: str) -> str:
    """Column-name slug of a field label (driver-side, few columns)."""
    s = unicodedata.normalize("NFKD", label).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "_", s).strip("_") or "field"


def flatten_custom_fields(df: DataFrame, map_col: str, fields: Sequence[dict]) -> DataFrame:
    """PRJ-11: hash-keyed custom fields -> named columns.

    ``fields``: [{"key": hash, "name": label, "type": "text"|"enum"|"set"|"monetary", "options": {id: label}}].
    Enum ids become labels, sets become ', '-joined labels, monetary values split into value and currency.
    """
    out = [F.col(c) for c in df.columns if c != map_col]
    for f in fields:
        raw = F.element_at(F.col(map_col), f["key"])
        name = slug(f["name"])
        typ = f.get("type", "text")
        if typ in ("enum", "set"):
            opts = F.create_map(*[x for k, v in f.get("options", {}).items() for x in (F.lit(str(k)), F.lit(v))])
            if typ == "enum":
                out.append(F.coalesce(F.element_at(opts, raw), raw).alias(name))
            else:
                ids = F.split(raw, ",")
                out.append(F.array_join(F.transform(ids, lambda i: F.coalesce(F.element_at(opts, F.trim(i)), F.trim(i))), ", ")
                           .alias(name))
        elif typ == "monetary":
            out.append(F.get_json_object(raw, "$.value").try_cast("double").alias(name))
            out.append(F.get_json_object(raw, "$.currency").alias(f"{name}_currency"))
        else:
            out.append(raw.alias(name))
    return df.select(*out)


MAIL_HEADERS = {"subject": "subject", "from": "from_addr", "to": "to_addr", "cc": "cc", "bcc": "bcc", "reply-to": "reply_to",
                "in-reply-to": "in_reply_to", "date": "email_date", "message-id": "email_message_id"}


def _attachments(parts: Column, kind: T.DataType) -> Column:
    """Attachments (a file name and an attachment id) of a list of parts and of all parts below, as deep as the schema goes."""
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        return F.lit(0)
    fields = {f.name: f.dataType for f in kind.elementType.fields}

    def of(p: Column) -> Column:
        own = F.coalesce(p["filename"], F.lit("")) != ""
        if "body" in fields:
            own = own & (F.coalesce(p["body"]["attachmentId"], F.lit("")) != "")
        below = _attachments(p["parts"], fields["parts"]) if "parts" in fields else F.lit(0)
        return own.cast("int") + below

    return F.coalesce(F.aggregate(F.transform(parts, of), F.lit(0), lambda a, b: a + b), F.lit(0))


def flatten_mail(df: DataFrame, headers_col: str = "headers", internal_ms: str = "internal_date",
                 parts_col: str = "parts") -> DataFrame:
    """PRJ-12: message headers (array of name/value) -> columns, epoch ms -> timestamp, attachment count and flag.

    Of repeated headers the last counts.  Parts are walked through all levels of the column's schema.
    """
    pairs = F.transform(F.col(headers_col), lambda h: F.struct(F.lower(h["name"]).alias("k"), h["value"].alias("v")))

    def header(name: str) -> Column:
        return F.try_element_at(F.filter(pairs, lambda h: h["k"] == name), F.lit(-1))["v"]

    n = _attachments(F.col(parts_col), df.schema[parts_col].dataType)
    return df.select("*", *(header(h).alias(c) for h, c in MAIL_HEADERS.items()),
                     F.timestamp_millis(F.col(internal_ms).cast("bigint")).alias("sent_at"),
                     n.alias("attachments"), (n > 0).alias("has_attachments"))


def norm_ref(c: str) -> Column:
    """PRJ-13: an id that may be an object ``{"value": id}`` / ``{"id": id}`` or a scalar -> the id text."""
    v = F.col(c).cast("string")
    return F.coalesce(F.get_json_object(v, "$.value"), F.get_json_object(v, "$.id"), v)


def first_of(c: str, field: str = "value") -> Column:
    """PRJ-13: first element's ``field`` of a list of {value, primary} (first email / phone)."""
    return F.get(F.col(c), 0)[field]
