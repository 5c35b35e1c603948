"""Entity resolution between two systems (JON-5..8): tax-id exact, then fuzzy name, then unmatched.

Fuzzy matching never forms a cross product.  Names are matched by the weighted ratio (``functions/similarity.py``) through the
inverted indexes of ``name_join``.  For the plain Levenshtein ratio there is an *exact* blocking scheme here, q-gram prefix filtering:

* score(a, b) = 100 * (1 - lev(a, b) / max(len a, len b)); a match needs
  score >= t, so lev <= (1 - t/100) * max len, and the partner's length is at
  most len/(t/100);  hence for a string of length L the edit budget is
  k = floor((1 - t/100) * L / (t/100));
* two strings within k edits share at least |G(a)| - k*q of their q-grams
  (count filter), so under one global order of the grams (rarest first) they
  share a gram among the first k*q + 1 of each (prefix filter).

Only prefix grams are joined, on distinct normalised names, and the exact
Levenshtein ratio is computed for those candidates alone; the best partner per
name is a partial aggregate.  Rarest-first prefixes keep common grams out of
the join, so the candidate set stays close to the true matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops import params as P
from lakeops.functions import columns as C
from lakeops.operators.name_join import best_similar
from lakeops.session import cut_lineage

Q = 3


def match_key(c) -> Column:
    """Normalised name for matching: accents folded, upper case, non-alphanumerics -> single space, trimmed."""
    s = F.upper(C.strip_accents(C.col(c)))
    return F.trim(F.regexp_replace(s, "[^A-Z0-9]+", " "))


def ratio(a: Column, b: Column) -> Column:
    """Levenshtein similarity in [0, 100] (DOUBLE)."""
    m = F.greatest(F.length(a), F.length(b))
    return F.when(m == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b).cast("double") / m.cast("double")))


def _grams(names: DataFrame, side: str, q: int = Q) -> DataFrame:
    """(side, name, gram, occ) for every q-gram occurrence of every distinct name."""
    n = F.col("name")
    g = names.select(F.lit(side).alias("side"), "name", "budget",
                     F.explode(F.transform(F.sequence(F.lit(1), F.length(n) - q + 1), lambda i: F.substring(n, i, q)))
                     .alias("gram"))
    w = Window.partitionBy("side", "name", "gram").orderBy("gram")
    return g.withColumn("occ", F.row_number().over(w))


def edit_budget(length: Column, threshold: float) -> Column:
    """Largest edit distance a partner may have: floor((100 - t) * L / t), in exact integer arithmetic."""
    ts = int(round(threshold * 1000))
    return F.floor((F.lit(100000 - ts) * length) / F.lit(ts)).cast("int")


def deletion_variants(names: DataFrame) -> DataFrame:
    """(nid, vh) for every string reachable from ``name`` by deleting up to ``budget`` (<= 2) characters.

    Names and variants travel as 64-bit hashes (``nid`` = xxhash64(name), ``vh`` = xxhash64(variant)):
    the shuffles carry two longs per row.  A hash collision can only *add* candidate pairs, and every
    candidate is verified with the exact ratio, so the blocking stays complete.  Positions come from
    ``explode(sequence(...))`` so the slicing is plain ``substr``/``concat`` inside whole-stage codegen.
    """
    n = names.select("name", "budget", F.length("name").alias("_L"), F.xxhash64("name").alias("nid"))
    v0 = n.select("nid", F.xxhash64("name").alias("vh"))
    d1 = n.where((F.col("budget") >= 1) & (F.col("_L") >= 1)).select(
        "name", "nid", "budget", "_L", F.explode(F.sequence(F.lit(1), F.col("_L"))).alias("i"))
    v1 = d1.select("nid", F.xxhash64(F.expr("concat(substr(name, 1, i - 1), substr(name, i + 1))")).alias("vh"))
    d2 = d1.where((F.col("budget") >= 2) & (F.col("i") < F.col("_L"))).select(
        "name", "nid", "i", F.explode(F.sequence(F.col("i") + 1, F.col("_L"))).alias("j"))
    v2 = d2.select("nid", F.xxhash64(F.expr(
        "concat(substr(name, 1, i - 1), substr(name, i + 1, j - i - 1), substr(name, j + 1))")).alias("vh"))
    return v0.unionByName(v1).unionByName(v2).distinct()


def _prefix_candidates(lp: DataFrame, rp: DataFrame, q: int) -> DataFrame:
    lg, rg = _grams(lp, "L", q), _grams(rp, "R", q)
    allg = lg.unionByName(rg)
    freq = allg.groupBy("gram", "occ").agg(F.count("*").alias("f"))
    ranked = allg.join(freq, ["gram", "occ"])
    w = Window.partitionBy("side", "name").orderBy("f", "gram", "occ")
    pref = ranked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.col("budget") * q + 1)
    lq = pref.where(F.col("side") == "L").select(F.col("name").alias("lname"), "gram", "occ")
    rq = pref.where(F.col("side") == "R").select(F.col("name").alias("rname"), "gram", "occ")
    return lq.join(rq, ["gram", "occ"]).select("lname", "rname")


def gram_size(threshold: float, shortest: int, largest: int = Q) -> int:
    """Largest q whose prefix filter is complete for all names of ``shortest`` characters or more.

    A name of L characters has L - q + 1 grams, of which k edits spoil at most k * q: one must be left.
    """
    ts = int(round(threshold * 1000))
    for q in range(largest, 0, -1):
        # beyond a few hundred characters the slope decides: 1 - q (100 - t) / t
        if q * (100000 - ts) < ts and all(n - q >= q * ((100000 - ts) * n // ts) for n in range(max(q, shortest), max(q, shortest) + 400)):
            return q
    raise ValueError(f"similarity {threshold} is too low for candidate generation: it must be over 50")


def fuzzy_candidates(left_names: DataFrame, right_names: DataFrame, threshold: float, q: int = Q,
                     deletion_max: int = 2) -> DataFrame:
    """Distinct (lname, rname) pairs that may reach ``threshold`` (complete for the ratio above).

    Two exact generators, chosen by each name's edit budget k (see module doc):

    * k <= ``deletion_max``: symmetric deletion neighbourhoods — strings within k
      edits share a string reachable by <= k deletions from both; joined on that string;
    * longer names: q-gram prefix filtering, with the largest gram up to ``q`` for which it is complete
      (``gram_size``; thresholds of 50 or less are refused).

    A pair whose longer member has k > ``deletion_max`` has both members at least
    ceil(t * L_K) long (L_K: first length with that budget), so the prefix side
    covers every such name; the two sets overlap and every pair is generated.
    """
    t = threshold / 100.0

    def prep(df):
        L = F.length("name")
        return df.select("name").distinct().where(L >= 1).withColumn("budget", edit_budget(L, threshold))

    lp, rp = prep(left_names), prep(right_names)
    ts = int(round(threshold * 1000))
    k1 = deletion_max + 1
    L_K = -(-k1 * ts // (100000 - ts)) if ts < 100000 else 10 ** 9  # ceil((K+1) t / (100 - t))
    p_min = -(-ts * L_K // 100000)  # ceil(t * L_K)
    q = gram_size(threshold, p_min, q)
    p_min = max(q, p_min)
    ld = lp.where(F.col("budget") <= deletion_max)
    rd = rp.where(F.col("budget") <= deletion_max)
    lv = deletion_variants(ld).select(F.col("nid").alias("lid_"), "vh")
    rv = deletion_variants(rd).select(F.col("nid").alias("rid_"), "vh")
    pairs = lv.join(rv, "vh").select("lid_", "rid_").distinct()
    lnames = ld.select(F.xxhash64("name").alias("lid_"), F.col("name").alias("lname"))
    rnames = rd.select(F.xxhash64("name").alias("rid_"), F.col("name").alias("rname"))
    by_deletion = pairs.join(lnames, "lid_").join(rnames, "rid_").select("lname", "rname")
    lpp = lp.where(F.length("name") >= p_min)
    rpp = rp.where(F.length("name") >= p_min)
    # 1-row probes: an empty side means that generator cannot produce a pair, so it is not planned
    parts = []
    if not (ld.isEmpty() or rd.isEmpty()):
        parts.append(by_deletion)
    if not (lpp.isEmpty() or rpp.isEmpty()):
        parts.append(_prefix_candidates(lpp, rpp, q))
    if not parts:
        return lp.sparkSession.createDataFrame([], "lname string, rname string")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.distinct()


def resolve_entities(left: DataFrame, right: DataFrame, *, left_id="partner_code", left_name="partner_name",
                     left_tax="tax_id", right_id="org_id", right_name="org_name", right_tax="cnpj",
                     threshold: float = P.FUZZY_THRESHOLD, min_len: int = P.FUZZY_MIN_LENGTH,
                     tax_len: int = P.TAX_ID_COMPANY_LENGTH, crm_tax_min: int = P.CRM_TAX_ID_MIN_DIGITS) -> DataFrame:
    """JON-6: bridge rows (left id, left name, right id, right name, match_type, match_score).

    1. tax id exact (company ids of ``tax_len`` digits on the left, >= ``crm_tax_min`` digits on the right),
       every matching right entity kept;
    2. fuzzy name >= ``threshold`` on names of >= ``min_len`` characters, for left rows without a tax match;
    3. the rest as 'unmatched'.
    """
    # The two inputs feed four branches (tax, fuzzy left/right, unmatched); cut lineage once into the
    # shared checkpoint folder so each branch reads the materialised rows instead of re-running the
    # source joins (reliable checkpoint: survives executor loss).
    L = cut_lineage(left.select(F.col(left_id).alias("lid"), F.col(left_name).alias("lname_raw"),
                                C.digits_only(F.col(left_tax)).alias("ltax")).withColumn("name", match_key("lname_raw")))
    R = cut_lineage(right.select(F.col(right_id).alias("rid"), F.col(right_name).alias("rname_raw"),
                                 C.digits_only(F.col(right_tax)).alias("rtax")).withColumn("name", match_key("rname_raw")))
    lt = L.where(F.length("ltax") == tax_len)
    rt = R.where(F.length("rtax") >= crm_tax_min)
    tax = lt.drop("name").join(rt.drop("name"), lt.ltax == rt.rtax).select("lid", "lname_raw", "rid", "rname_raw",
                                                   F.lit("cnpj_exact").alias("match_type"), F.lit(100.0).alias("match_score"))
    rest = L.join(tax.select("lid").distinct(), "lid", "left_anti")
    Rn = R
    ok_l = rest.where(F.length("name") >= min_len)
    ok_r = Rn.where(F.length("name") >= min_len)
    best = best_similar(ok_l.select("name"), ok_r.select("name"), threshold)
    # every right entity carrying the best name is a partner; keep the smallest id (deterministic)
    rmin = ok_r.groupBy(F.col("name").alias("rname")).agg(F.min(F.struct("rid", "rname_raw")).alias("r"))
    hit = best.join(rmin, "rname").select(F.col("lname").alias("name"), F.col("r.rid").alias("f_rid"),
                                          F.col("r.rname_raw").alias("f_rname"), F.col("score").alias("f_score"))
    # one left join yields both the fuzzy matches and the unmatched rows (the fuzzy plan runs once)
    rj = rest.join(hit, (rest.name == hit.name) & (F.length(rest.name) >= min_len), "left")
    found = F.col("f_rid").isNotNull()
    rest_out = rj.select("lid", "lname_raw", F.col("f_rid").alias("rid"), F.col("f_rname").alias("rname_raw"),
                         F.when(found, "name_fuzzy").otherwise("unmatched").alias("match_type"),
                         F.when(found, F.col("f_score")).alias("match_score"))
    out = tax.unionByName(rest_out)
    return out.select(F.col("lid").alias(left_id), F.col("lname_raw").alias(left_name), F.col("rid").alias(right_id),
                      F.col("rname_raw").alias(right_name), "match_type", "match_score")


def best_bridge(bridge: DataFrame, key: str = "partner_code") -> DataFrame:
    """JON-5: one bridge row per key: exact tax match before fuzzy, then highest score, then smallest org id."""
    b = bridge.where(F.col("match_type") != "unmatched")
    pri = F.when(F.col("match_type") == "cnpj_exact", 1).when(F.col("match_type") == "name_fuzzy", 2).otherwise(3)
    rest = [c for c in b.columns if c != key]
    s = F.struct(pri.alias("p"), (-F.col("match_score")).alias("s"), F.col("org_id").alias("o"), F.struct(*rest).alias("row"))
    return b.groupBy(key).agg(F.min(s).alias("m")).select(key, "m.row.*")


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """WIN-3: the most frequent ``value`` per ``key`` (ties -> the largest value)."""
    c = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return c.groupBy(key).agg(F.max(F.struct(F.col("n"), F.col(value))).alias("m")).select(
        key, F.col(f"m.{value}").alias(value))


def match_report(bridge: DataFrame) -> DataFrame:
    """A-QA-8: count and % by match type, distinct linked codes and orgs."""
    g = bridge.groupBy("match_type").agg(F.count("*").alias("rows"), F.countDistinct("partner_code").alias("codes"),
                                         F.countDistinct("org_id").alias("orgs"))
    tot = g.agg(F.sum("rows").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select("match_type", "rows", "codes", "orgs", C.pct("rows", "_t").alias("pct"))


def borderline(bridge: DataFrame, review_below: float = P.FUZZY_REVIEW_BELOW) -> DataFrame:
    """A-QA-8: fuzzy matches below the review limit (for manual review), lowest score first."""
    return bridge.where((F.col("match_type") == "name_fuzzy") & (F.col("match_score") < F.lit(float(review_below))))


def client_universe(portfolio: DataFrame, orders: DataFrame, ref: str, months: int = 24) -> DataFrame:
    """JON-7: portfolio clients plus clients that bought in the last ``months`` and are not in the portfolio."""
    recent = orders.where(F.col("invoice_date") >= F.add_months(F.lit(ref).cast("date"), -months)).select("partner_code").distinct()
    extra = recent.join(portfolio.select("partner_code"), "partner_code", "left_anti")
    p = portfolio.select("partner_code", F.lit("portfolio").alias("origin")).distinct()
    return p.unionByName(extra.withColumn("origin", F.lit("active_24m")))


def match_list(names: DataFrame, master: DataFrame, threshold: float = P.FUZZY_THRESHOLD) -> DataFrame:
    """JON-8: match a name list to master names (exact normalised name, else best fuzzy), returning all codes of the name."""
    n = names.select(F.col("name").alias("input_name")).distinct().withColumn("name", match_key("input_name"))
    m = master.select("partner_code", F.col("partner_name")).withColumn("name", match_key("partner_name"))
    exact = n.join(m.select("name").distinct(), "name").select("input_name", "name", F.lit(100.0).alias("score"),
                                                                F.lit("exact").alias("how"))
    rest = cut_lineage(n.join(exact.select("input_name"), "input_name", "left_anti"))
    best = best_similar(rest.select("name"), m.select("name"), threshold)
    fz = rest.join(best, rest.name == best.lname).select("input_name", F.col("rname").alias("name"), "score",
                                                         F.lit("fuzzy").alias("how"))
    return exact.unionByName(fz).join(m.select("name", "partner_code"), "name")
