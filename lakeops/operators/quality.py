"""Data quality: corrupted-term repair, city matching, state normalisation, reports, profiles,
the entity transform pipeline and label mapping (QLT-1..8).

Term repair works on the *distinct affected values* only (values that hold the corruption marker).  The
dictionary can be any size: automata over bounded parts of it read each value once, and the
replacements found are folded over the value in one projection.  Reports keep at most N samples per column with a two-stage bounded
top-N (per hash bucket, then per column), so a column with millions of distinct values never sorts in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.functions import similarity as SM
from lakeops.operators import name_join as NJ
from lakeops.session import cut_lineage

MARKER = "?"


def corrupt(c) -> Column:
    """The corruption seen in the source: every accented letter became '?'."""
    return F.translate(C.col(c), P.ACCENTED, MARKER * len(P.ACCENTED))


def build_dictionary(texts: DataFrame, col: str, min_length: int = 4) -> DataFrame:
    """Dictionary (corrupted token -> original token) from clean texts: the most frequent original per corrupted form.

    Tokens shorter than ``min_length`` are left out: as substrings they would fit almost anywhere.
    """
    toks = texts.select(F.explode(F.split(F.col(col), " ")).alias("token")).where(
        (F.col("token").contains(MARKER) == False) & (F.length("token") >= min_length))  # noqa: E712
    acc = toks.where(F.col("token") != corrupt("token")).select(corrupt("token").alias("pattern"), "token")
    cnt = acc.groupBy("pattern", "token").agg(F.count("*").alias("n"))
    best = cnt.groupBy("pattern").agg(F.max(F.struct("n", "token")).alias("b"))
    return best.select("pattern", F.col("b.token").alias("replacement"))


PART_PATTERNS = 50_000  # patterns of one automaton
SLICE_CHARS = 4_000_000  # characters of the values that one automaton reads in a task
FOUND = "_id long, _found array<struct<n: int, pattern: string, replacement: string>>"


def _found_in(t: pa.Table) -> pa.Table:
    """Patterns (kind 0) that occur in each value (kind 1) of a task: one automaton, one pass over each value."""
    import ahocorasick

    rows = t.select(["kind", "id", "text", "replacement"]).to_pylist()
    replacements: dict[str, list[str]] = {}
    for r in rows:
        if r["kind"] == 0:
            replacements.setdefault(r["text"], []).append(r["replacement"])
    ids, found = [], []
    if replacements:
        automaton = ahocorasick.Automaton()
        for pattern in replacements:
            automaton.add_word(pattern, pattern)
        automaton.make_automaton()
        for r in rows:
            if r["kind"] == 1 and (hits := {pattern for _, pattern in automaton.iter(r["text"])}):
                ids.append(r["id"])
                found.append([{"n": -len(p), "pattern": p, "replacement": x} for p in hits for x in replacements[p]])
    kind = pa.list_(pa.struct([("n", pa.int32()), ("pattern", pa.string()), ("replacement", pa.string())]))
    return pa.table({"_id": pa.array(ids, pa.int64()), "_found": pa.array(found, kind)})


def _folded(value: str, found: list[tuple[int, str, str]], one_by_one: int = 20_000_000) -> str:
    """``value`` with the found (-length, pattern, replacement) replaced one after the other.

    Where that would read the value too often, all occurrences are taken in one pass of an automaton.  This is the same if the replacements
    are as long as their patterns and what they change is in no pattern: a match is then one of the value as it was, none of whose
    characters has been changed before.  If that does not hold, they are replaced one after the other all the same.
    """
    found = sorted(set(found))
    if len(found) * len(value) > one_by_one:
        changes = {p: [i for i, (a, b) in enumerate(zip(p, r, strict=False)) if a != b] for _, p, r in found}
        new = {r[i] for _, p, r in found for i in changes[p]}
        if len(changes) == len(found) and all(len(p) == len(r) for _, p, r in found) and not new & {c for _, p, _ in found for c in p}:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for rank, (_, p, r) in enumerate(found):
                automaton.add_word(p, (rank, p, r))
            automaton.make_automaton()
            text, changed, last = list(value), bytearray(len(value)), (-1, 0)
            for rank, start, p, r in sorted((rank, end - len(p) + 1, p, r) for end, (rank, p, r) in automaton.iter(value)):
                n = len(p)
                if (rank == last[0] and start < last[1]) or changed.find(1, start, start + n) >= 0:
                    continue  # overlaps the occurrence before it, or is no longer there
                last = (rank, start + n)
                for i in changes[p]:
                    text[start + i], changed[start + i] = r[i], 1
            return "".join(text)
    for _, pattern, replacement in found:
        value = value.replace(pattern, replacement)
    return value


def _fold(batches):
    for batch in batches:
        values, found = batch.column("_v").to_pylist(), batch.column("_found").to_pylist()
        fixed = [_folded(v, [(f["n"], f["pattern"], f["replacement"]) for f in fs]) for v, fs in zip(values, found, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_v"), pa.array(fixed, pa.string())], names=["_id", "_v", "_fixed"])


def repair_terms(df: DataFrame, col: str, dictionary: DataFrame, out: str | None = None) -> DataFrame:
    """QLT-1: replace every occurrence of the dictionary's patterns in ``col`` (pattern -> replacement), longest pattern
    first and of equal ones in order of text, as a literal substring; values without the marker stay as they are.

    The patterns found in a value as it is are folded over it.  They are found by automata (tries with failure links), each over a part of the
    dictionary of PART_PATTERNS patterns at most: a part meets each slice of the distinct affected values in a task of its own, so neither
    the dictionary nor the values are bounded.
    """
    out = out or col
    pats = cut_lineage(dictionary.where(F.col("pattern").contains(MARKER)).select("pattern", "replacement").distinct())
    values = cut_lineage(df.select(F.col(col).alias("_v")).where(F.col("_v").contains(MARKER)).distinct().withColumn("_id", F.xxhash64("_v")))
    parts = max(1, -(-pats.count() // PART_PATTERNS))
    n, chars = values.agg(F.count(F.lit(1)), F.sum(F.length("_v"))).first()
    slices = max(1, -(-(chars or 0) // SLICE_CHARS), min(8, n // 64))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = pats.select(F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), F.col("pattern").alias("text"), "replacement",
                       F.pmod(F.xxhash64("pattern"), F.lit(parts)).cast("int").alias("part"), each(slices).alias("slice"))
    right = values.select(F.lit(1).alias("kind"), F.col("_id").alias("id"), F.col("_v").alias("text"), F.lit(None).cast("string").alias("replacement"),
                          each(parts).alias("part"), F.pmod("_id", F.lit(slices)).cast("int").alias("slice"))
    found = (left.unionByName(right).groupBy("part", "slice").applyInArrow(_found_in, FOUND)
             .groupBy("_id").agg(F.flatten(F.collect_list("_found")).alias("_found")))
    fixed = values.join(found, "_id").select("_id", "_v", "_found").mapInArrow(_fold, "_id long, _v string, _fixed string")
    j = df.join(fixed, (F.xxhash64(df[col]) == fixed["_id"]) & (df[col] == fixed["_v"]), "left")
    return j.withColumn(out, F.coalesce(F.col("_fixed"), F.col(col))).drop("_id", "_v", "_fixed")


# -- QLT-2 city matching ---------------------------------------------------------------

def _min_score(length: Column, bands=P.CITY_MIN_SCORES, longer: float = P.CITY_MIN_SCORE_LONG) -> Column:
    """Fuzzy minimum by length: short names tolerate more difference."""
    out = F.lit(longer)
    for most, score in reversed(bands):
        out = F.when(length <= most, F.lit(score)).otherwise(out)
    return out


def city_text(c: Column) -> Column:
    """As cities are compared: lower case, what is no letter, digit or underscore as a space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]", " "))


def city_score(v: Column, rc: Column) -> Column:
    return SM.subsequence_ratio(city_text(v), city_text(rc))


def match_cities(df: DataFrame, ref: DataFrame, city: str = "city", state: str = "state") -> DataFrame:
    """QLT-2: city names against the reference list.

    A name without the marker is kept if the list has it, and is otherwise not matched.  A corrupted name is matched by
    wildcard ('?' is one character), then by its common-subsequence ratio, in whole points, with a minimum that depends on its length; each
    first within its state, then in the whole list, and each only for names that the step before has left.
    Of several candidates the most similar wins, of equal ones the first by name.

    Works on distinct (name, state) pairs.  The wildcard step is an equi-join: each reference name is masked by
    the distinct marker patterns of its length.  Adds ``city_fixed`` and ``match_how``.
    """
    # the distinct values and the reference list feed all steps: materialise each once (reliable checkpoint)
    r = cut_lineage(ref.select(F.upper(F.col("city_name")).alias("rc"), F.upper(F.col("state_code")).alias("rs")).distinct())
    v = cut_lineage(df.select(F.upper(F.trim(F.col(city))).alias("v"), F.upper(F.col(state)).alias("s")).distinct().where(
        F.col("v").isNotNull() & (F.col("v") != "")))
    national = r.select("rc").distinct()
    damaged = v.where(F.col("v").contains(MARKER))

    def best(pairs: DataFrame, how: str) -> DataFrame:
        scored = pairs.withColumn("score", city_score(F.col("v"), F.col("rc")))
        top = scored.groupBy("v", "s").agg(F.min(F.struct((-F.col("score")).alias("_n"), F.col("rc").alias("fixed"))).alias("b"))
        return top.select("v", "s", F.col("b.fixed").alias("city_fixed"), F.lit(how).alias("match_how"))

    def left_by(rows: DataFrame, done: DataFrame) -> DataFrame:
        d = done.select(F.col("v").alias("_dv"), F.col("s").alias("_ds"))
        return rows.join(d, (F.col("v") == F.col("_dv")) & F.col("s").eqNullSafe(F.col("_ds")), "left_anti")

    exact = v.where(~F.col("v").contains(MARKER)).join(national, F.col("v") == F.col("rc")).select(
        "v", "s", F.col("rc").alias("city_fixed"), F.lit("exact").alias("match_how"))
    mask = F.regexp_replace("v", r"[^?]", "x")
    masks = damaged.select(mask.alias("mask")).distinct().withColumn("_l", F.length("mask"))
    masked = r.withColumn("_l", F.length("rc")).join(masks, "_l").withColumn("mv", F.expr(
        "array_join(transform(sequence(1, _l), i -> if(substr(mask, i, 1) = '?', '?', substr(rc, i, 1))), '')")).select("rc", "rs", "mv")
    wild_s = best(damaged.join(masked, (F.col("v") == F.col("mv")) & (F.col("s") == F.col("rs"))), "wildcard")
    rest = left_by(damaged, wild_s)
    wild_n = best(rest.join(masked.select("rc", "mv").distinct(), F.col("v") == F.col("mv")), "wildcard_national")
    rest = cut_lineage(left_by(rest, wild_n))
    # whole points, halves to the even one: a score half a point under the minimum can reach it
    texts = rest.select("v").distinct().select("v", city_text(F.col("v")).alias("lname"), (_min_score(F.length("v")) - 0.5).alias("least"))
    listed = national.select("rc", city_text(F.col("rc")).alias("rname"))
    cand = NJ.subsequence_pairs(texts.select(F.col("lname").alias("name"), "least"), listed.select(F.col("rname").alias("name")))
    pairs = texts.join(cand, "lname").join(listed, "rname").select("v", "rc")
    near = cut_lineage(pairs.where(F.bround(city_score(F.col("v"), F.col("rc"))) >= _min_score(F.length("v"))))
    fuzzy_s = best(rest.join(near, "v").join(r.select(F.col("rc"), F.col("rs").alias("s")), ["rc", "s"], "left_semi"), "fuzzy")
    fuzzy_n = best(left_by(rest, fuzzy_s).join(near, "v"), "fuzzy_national")
    matched = exact.unionByName(wild_s).unionByName(wild_n).unionByName(fuzzy_s).unionByName(fuzzy_n)
    d = df.withColumn("_v", F.upper(F.trim(F.col(city)))).withColumn("_s", F.upper(F.col(state)))
    j = d.join(matched, (d._v == matched.v) & d._s.eqNullSafe(matched.s), "left")
    return j.drop("_v", "_s", "v", "s")


# -- QLT-3 .. QLT-8 ------------------------------------------------------------------------

def normalise_state(df: DataFrame, col: str, states: DataFrame) -> DataFrame:
    """QLT-3: state names or codes -> code (accent/case-insensitive), invalid -> NULL; ``states``: code, name."""
    st = states.select(F.upper(F.col("code")).alias("_code"), C.strip_accents_key(F.col("name")).alias("_key"))
    keys = st.select(F.col("_code").alias("_k"), F.col("_code").alias("_c")).unionByName(
        st.select(F.col("_key").alias("_k"), F.col("_code").alias("_c"))).distinct()
    j = df.withColumn("_k", C.strip_accents_key(F.col(col))).join(F.broadcast(keys), "_k", "left")
    return j.withColumn(col, F.col("_c")).drop("_k", "_c")


def unresolved_report(df: DataFrame, cols: Sequence[str], marker: str = MARKER, samples: int = 15,
                      buckets: int = 64) -> DataFrame:
    """QLT-4: per column, how many values still hold the marker, and up to ``samples`` of them (smallest first)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("x")).select("x.*").where(F.col("value").contains(marker))
    counts = long.groupBy("column").agg(F.count("*").alias("unresolved"))
    dv = long.distinct().withColumn("_b", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    w1 = Window.partitionBy("column", "_b").orderBy("value")
    stage1 = dv.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= samples)
    w2 = Window.partitionBy("column").orderBy("value")
    stage2 = stage1.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= samples)
    smp = stage2.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("samples"))
    return counts.join(smp, "column", "left")


def corruption_profile(df: DataFrame, cols: Sequence[str], marker: str = MARKER) -> DataFrame:
    """QLT-5: per column: non-blank values, corrupted values, % corrupted (one pass, then unpivot)."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("string")
        nb = v.isNotNull() & (F.trim(v) != "")
        aggs += [C.count_if(nb).alias(f"{c}__total"), C.count_if(nb & v.contains(marker)).alias(f"{c}__bad")]
    one = df.agg(*aggs)
    long = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__total").alias("total"),
                                                   F.col(f"{c}__bad").alias("corrupted")) for c in cols])).alias("x")).select("x.*")
    return long.withColumn("corrupted_pct", C.pct("corrupted", "total"))


def transform_entity(df: DataFrame, schema: dict[str, str], key: Sequence[str], ref: str, ts: str,
                     repair: tuple[str, DataFrame] | None = None, key_name: str = "sk", dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """QLT-7: repair -> clean -> dedup -> snapshot -> cast -> key -> audit, in that order."""
    from lakeops.operators import cdc, projection as PJ

    out = df
    if repair is not None:
        out = repair_terms(out, repair[0], repair[1])
    out = PJ.clean_strings(out)
    out = cdc.dedup(out, list(dedup_keys) if dedup_keys else None)
    out = PJ.add_snapshot_date(out, ref)
    out = PJ.cast_to_schema(out, {**schema, "snapshot_date": "date"})
    out = PJ.add_hash_key(out, key_name, list(key))
    return PJ.add_audit(out, ts)


def map_labels(df: DataFrame, col: str, mapping: DataFrame, default: str | None = None, out: str | None = None,
               exclude_pairs: DataFrame | None = None) -> DataFrame:
    """QLT-8: code -> label from a small mapping table (broadcast), default when unmapped; optional residual pairs removed."""
    out = out or f"{col}_label"
    m = F.broadcast(mapping.select(F.col("code").alias("_code"), F.col("label").alias("_label")))
    j = df.join(m, df[col] == m["_code"], "left")
    j = j.withColumn(out, F.coalesce(F.col("_label"), F.lit(default) if default is not None else F.col(col).cast("string")))
    j = j.drop("_code", "_label")
    if exclude_pairs is not None:
        j = j.join(exclude_pairs, [c for c in exclude_pairs.columns], "left_anti")
    return j
