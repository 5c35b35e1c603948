"""Similarity join of names: for each name on the left, the most similar one on the right by the weighted ratio.

Candidates come from inverted indexes, complete for every pair at or over the threshold t (as a share), and only candidates are scored:

* deletions: two names within two insertions and deletions of each other lead to a common text by leaving out characters; joined on its
  hash (names of up to 32 characters);
* words: where the shared words make a score of t / 0.95, one name has few characters in words that it does not share, so one of its
  rarest words is shared (``_word_pairs``);
* parts: a name that lies (almost) whole in one over 1.5 times as long shares one of its rarest 3-grams with it;
* grams: names with a ratio of s differ by D <= (1 - s)(la + lb) <= 2 (1 - s) la / s insertions and deletions.  Each spoils at most two
  2-grams.  Grams are taken inside words, padded with a space on each side, so they do not hang on the order of words, and of the
  2 D + 1 rarest of either name (in one global order) at least one is shared.

The first three give most names a good partner.  The gram index then looks only for partners that are no worse: s is the better of the threshold and
what the name has already, so its prefix is short or, where nothing better can exist, empty.  Names and pairs are distinct; frequent words, grams and
texts come last in the order and are met only by names that have nothing rarer.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions import similarity as S
from lakeops.session import cut_lineage

DELETIONS = 2
DELETION_LENGTH = 32
GRAM = 2
PART_GRAM = 3
LOWEST = 100.0 * S.WORD_SCALE * S.PART_SCALE  # one shared word gives names of unlike lengths that much
TINY = 1e-9
STEPS = [s for s in itertools.product(range(DELETIONS + 1), repeat=2) if sum(s)]  # characters that the left and the right name lose
GRAM_SLOTS = 1 << 16  # that grams are counted by, whatever the names
TOGETHER, MANY_EDITS = 3, 4  # grams that are joined at a time, for names of so many edits at most
MANY_ROWS = 1_000_000  # rows of a side from which on those that the other side cannot meet are left out before the shuffle
SEEN_WORDS = 1 << 19  # of 64 bits that say which keys a side has: 4 MB, whatever the names


def _names(df: DataFrame) -> DataFrame:
    n = F.length("name")
    return df.select("name").where(n >= 1).distinct().select("name", n.alias("len"), F.xxhash64("name").alias("nid"))


# --- candidates by deletions, words and parts -------------------------------------------------------
def _shuffled(df: DataFrame) -> DataFrame:
    """Rows that come out of an ``explode``: Spark does not count them, takes them for small and would collect them on the driver."""
    return df.hint("merge")


def _seen_only(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows whose ``vh`` falls on a bit that a ``vh`` of ``others`` sets: all that meet one of them, and few others."""
    def word(of: str) -> str:
        return f"({of} & {SEEN_WORDS - 1})"

    def bit(of: str) -> str:
        return f"cast(shiftrightunsigned({of}, 32) & 63 as int)"

    bits = others.select(F.expr(word("vh")).alias("word"), F.expr(f"shiftleft(1L, {bit('vh')})").alias("bits"))
    none = rows.sparkSession.range(SEEN_WORDS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    seen = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("all")).select(F.transform("all", lambda x: x["bits"]).alias("seen"))
    # one row of fixed size
    return rows.join(F.broadcast(seen), F.expr(f"getbit(get(seen, cast({word('vh')} as int)), {bit('vh')}) = 1"), "left_semi")


def _meeting(left: DataFrame, right: DataFrame, n_left: int, n_right: int) -> tuple[DataFrame, DataFrame]:
    """Two sides that are joined on ``vh``, the larger without most of the rows that meet nothing; of about so many rows."""
    if max(n_left, n_right) < MANY_ROWS or min(n_left, n_right) > 64 * SEEN_WORDS:
        return left, right
    return (_seen_only(left, right), right) if n_left >= n_right else (left, _seen_only(right, left))


def _lengths(names: DataFrame) -> list[int]:
    """The lengths of names that deletions may handle: DELETION_LENGTH of them at most."""
    return sorted(r[0] for r in names.where(F.col("len") <= DELETION_LENGTH).select("len").distinct().collect())


def _shortened(names: DataFrame, k: int) -> DataFrame:
    """(nid, len, vh): hashes of the texts that are left after leaving out k characters; of equal neighbours the last ones go."""
    ends = lambda i: F.expr(f"substr(name, {i}, 1) != substr(name, {i} + 1, 1)")
    if k == 0:
        return names.select("nid", "len", F.xxhash64("name").alias("vh"))
    once = names.select("nid", "name", "len", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("i"))
    if k == 1:
        return once.where(ends("i")).select("nid", "len", F.xxhash64(F.expr("concat(substr(name, 1, i - 1), substr(name, i + 1))")).alias("vh"))
    twice = once.where(F.col("i") < F.col("len")).select("nid", "name", "len", "i", F.explode(F.sequence(F.col("i") + 1, F.col("len"))).alias("j"))
    return twice.where(ends("j") & (ends("i") | (F.col("j") == F.col("i") + 1))).select(
        "nid", "len", F.xxhash64(F.expr("concat(substr(name, 1, i - 1), substr(name, i + 1, j - i - 1), substr(name, j + 1))")).alias("vh"))


def _variants(left: DataFrame, right: DataFrame, steps: list[tuple[int, int]], lengths: tuple[list[int], list[int]]) -> tuple[DataFrame, DataFrame] | None:
    """Texts (vh) that the left names (lid, len) lead to by losing i characters and the right ones (rid) by losing j, for (i, j) in ``steps``.

    Names are shortened only where the other side has names of the length that a step asks for, and where the
    step's ratio reaches the left name's ``least``.
    """
    sides: list[dict[int, Column]] = [{}, {}]
    for i, j in steps:
        fits = [n for n in lengths[0] if n - i + j in lengths[1]]
        if not fits:
            continue
        reach = 200.0 * (F.col("len") - i) / (2 * F.col("len") - i + j) >= F.col("least") - TINY
        for side, k, cond in ((0, i, F.col("len").isin(fits) & reach), (1, j, F.col("len").isin([n - i + j for n in fits]))):
            sides[side][k] = sides[side][k] | cond if k in sides[side] else cond

    def variants(names: DataFrame, of: dict[int, Column], nid: str, lost: str) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [_shortened(names.where(cond), k).select(F.col("nid").alias(nid), "len", "vh", F.lit(k).alias(lost)) for k, cond in of.items()])

    def n_variants(names: DataFrame, of: dict[int, Column]) -> int:
        n = F.col("len")
        return names.agg(*[F.sum(F.when(cond, (F.lit(1), n, n * (n - 1) / 2)[k])).cast("long").alias(f"n_{k}") for k, cond in of.items()]).select(
            functools.reduce(Column.__add__, [F.coalesce(F.col(f"n_{k}"), F.lit(0)) for k in of])).first()[0]

    if not sides[0]:
        return None
    return _meeting(variants(left, sides[0], "lid", "i"), variants(right, sides[1], "rid", "j").drop("len"),
                    n_variants(left, sides[0]), n_variants(right, sides[1]))


def _deletion_pairs(left: DataFrame, right: DataFrame, steps: list[tuple[int, int]], lengths: tuple[list[int], list[int]]) -> DataFrame | None:
    """Pairs of which the left name loses i characters and the right one j, for (i, j) in ``steps``, and a common text is left; ``common``: its length."""
    sides = _variants(left, right, steps, lengths)
    if sides is None:
        return None
    lv, rv = sides
    near = F.col("i") + F.col("j") <= max(i + j for i, j in steps)
    return _shuffled(lv).join(_shuffled(rv), "vh").where(near).select("lid", "rid", (F.col("len") - F.col("i")).alias("common"))


def _deletion_best(left: DataFrame, right: DataFrame, steps: list[tuple[int, int]], lengths: tuple[list[int], list[int]]) -> DataFrame | None:
    """(lid, lname, rname, score): of the pairs by deletions the one with the best plain ratio, for each left name; right: also ``rank``.

    Of the right names that lose j characters for a text, all give a left name the same ratio, so the first by ``rank`` stands for them.
    Where another form gives a pair more than its plain ratio, the pair comes from that form's own index.  Texts are told by
    64-bit hashes, as names are.
    """
    sides = _variants(left, right.withColumn("nid", F.col("rank")), steps, lengths)
    if sides is None:
        return None
    lv, rv = sides
    most = max(i + j for i, j in steps)
    lost = [s for s in itertools.product(range(DELETIONS + 1), repeat=2) if sum(s) <= most]
    texts = _shuffled(rv).groupBy("vh").agg(*[F.max(F.when(F.col("j") == j, F.col("rid"))).alias(f"r{j}") for j in range(DELETIONS + 1)])
    best = _shuffled(lv).join(_shuffled(texts), "vh").groupBy("lid").agg(
        *[F.max(F.when(F.col("i") == i, F.col(f"r{j}"))).alias(f"r{i}{j}") for i, j in lost])
    n = F.col("len")
    found = [F.when(F.col(f"r{i}{j}").isNotNull(), F.struct((F.lit(200.0) * (n - i).cast("double") / (2 * n - i + j).cast("double")).alias("score"),
                                                            F.col(f"r{i}{j}").alias("rank"), (n - i).alias("common"))) for i, j in lost]
    named = (best.join(_shuffled(left.select(F.col("nid").alias("lid"), F.col("name").alias("lname"), "len")), "lid")
             .select("lid", "lname", F.array_max(F.array(*found)).alias("b")).where(F.col("b").isNotNull())
             .select("lid", "lname", "b.score", "b.rank", "b.common"))
    both = _shuffled(named).join(_shuffled(right.select("rank", F.col("name").alias("rname"))), "rank")
    # equal hashes of unlike texts: the names are too far apart
    return both.where(F.levenshtein("lname", "rname") <= F.length("lname") + F.length("rname") - 2 * F.col("common")).select("lid", "lname", "rname", "score")


def _best_missed(length: Column, lengths: list[int], t: float) -> Column:
    """The best ratio (0 to 1) that a name may have with one that deletions miss: one of the two loses over DELETIONS characters."""
    def most(la: int) -> float:
        best = 0.0
        for lb in lengths:
            lost = max(0, DELETIONS + 1 - (lb - la)) if lb >= la else max(DELETIONS + 1, la - lb)
            best = max(best, 2.0 * (la - lost) / (la + lb))
        return best

    table = F.array(*[F.lit(most(la)) for la in range(1, DELETION_LENGTH + 1)])
    # partners may be that long
    return F.when(length * (2 - t) / t <= DELETION_LENGTH, F.get(table, length - 1)).otherwise(F.lit(1.0))


def _word_index(names: DataFrame) -> DataFrame:
    w = F.array_distinct(S.words(F.col("name")))
    return names.select("nid", F.length(F.array_join(w, " ")).alias("chars"), F.explode(w).alias("word"))


def _word_pairs(left: DataFrame, right: DataFrame, share: float) -> DataFrame:
    """Pairs in which the shared words reach ``share`` (as a ratio) of one of the names.

    With n characters of shared words, 2 n / (n + full) >= share, so at most full (2 - 2 share) / (2 - share) characters are not shared.
    Words go rarest first; once those before a word are longer than that, one up to there is shared.
    """
    lw, rw = _word_index(left), _word_index(right)
    spare = (2 - 2 * share) / (2 - share)

    def prefix(index: DataFrame, other: DataFrame) -> DataFrame:
        # words that the other side has not are the rarest there: they stand before all others
        seen = other.groupBy("word").agg(F.count("*").alias("f"))
        shared = _shuffled(index).join(seen, "word").withColumn("size", F.length("word") + 1)
        of_name, sofar = Window.partitionBy("nid"), Window.partitionBy("nid").orderBy("f", "word").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("chars") + 1 - F.sum("size").over(of_name) + F.coalesce(F.sum("size").over(sofar), F.lit(0))
        return shared.withColumn("before", before).where(F.col("before") <= F.col("chars") * spare + 1 + TINY).select("nid", "word")

    one = _shuffled(prefix(lw, rw).withColumnRenamed("nid", "lid")).join(_shuffled(rw.select("word", F.col("nid").alias("rid"))), "word")
    other = _shuffled(lw.select("word", F.col("nid").alias("lid"))).join(_shuffled(prefix(rw, lw).withColumnRenamed("nid", "rid")), "word")
    return one.select("lid", "rid").unionByName(other.select("lid", "rid"))


def _slot(*gram: Column) -> Column:
    return F.xxhash64(*gram).bitwiseAND(GRAM_SLOTS - 1).cast("int")


def _gram_counts(slot, *indexes: DataFrame) -> Column:
    """A byte for each of GRAM_SLOTS slots, larger where more of the names' ``grams`` fall in it; an order for which nothing is shuffled but the slots' counts.

    A literal: joined to the names, it would be copied for every name.
    """
    slots = functools.reduce(DataFrame.unionByName, [x.select(F.explode("grams").alias("x")) for x in indexes]).select(slot(F.col("x")).alias("slot"), F.lit(1).alias("n"))
    none = indexes[0].sparkSession.range(GRAM_SLOTS).select(F.col("id").cast("int").alias("slot"), F.lit(0).alias("n"))
    sizes = slots.unionByName(none).groupBy("slot").agg(F.least(F.floor(8 * F.log2(F.sum("n") + 1)), F.lit(255)).cast("int").alias("n"))
    return F.lit(bytearray(sizes.agg(F.array_sort(F.collect_list(F.struct("slot", "n"))).alias("all")).select(F.transform("all", lambda x: x["n"])).first()[0]))


def _often(counts: Column, slot: Column) -> Column:
    return F.substr(counts, slot + 1, F.lit(1))


def _part_index(names: DataFrame) -> DataFrame:
    """Distinct 3-grams; a shorter name is its own only one."""
    n = F.col("len") - PART_GRAM + 1
    grams = F.when(n >= 1, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col("name"), i, PART_GRAM)))
    return names.where(n >= 1).select("nid", "len", F.array_distinct(grams).alias("grams"))


def _part_pairs(left: DataFrame, right: DataFrame, share: float) -> DataFrame:
    """Pairs of which one is over 1.5 times as long as the other, and holds a part with a ratio of ``share`` to it."""
    li, ri = _part_index(left), _part_index(right)
    counts = _gram_counts(_slot, li, ri)
    first = (PART_GRAM * F.floor(2 * (1 - share) * F.col("len") / share + TINY) + 1).cast("int")

    def prefix(index: DataFrame) -> DataFrame:
        order = F.array_sort(F.transform("grams", lambda x: F.struct(_often(counts, _slot(x)).alias("f"), x.alias("gram"))))
        return index.select("nid", "len", F.explode(F.slice(order, F.lit(1), first)).alias("x")).select("nid", "len", F.xxhash64("x.gram").alias("vh"))

    def whole(index: DataFrame) -> DataFrame:
        return index.select("nid", "len", F.explode("grams").alias("x")).select("nid", "len", F.xxhash64("x").alias("vh"))

    def rows(index: DataFrame, most: Column) -> int:
        return index.agg(F.sum(F.least(F.size("grams"), most))).first()[0] or 0

    def pairs(short: DataFrame, long: DataFrame, short_id: str, long_id: str) -> DataFrame:
        s, o = _meeting(prefix(short), whole(long), rows(short, first), rows(long, F.size("grams")))
        met = _shuffled(s).alias("s").join(_shuffled(o).alias("l"), (F.col("s.vh") == F.col("l.vh")) & (F.col("l.len") >= F.col("s.len") * S.LONGER))
        return met.select(F.col("s.nid").alias(short_id), F.col("l.nid").alias(long_id))

    return pairs(li, ri, "lid", "rid").unionByName(pairs(ri, li, "rid", "lid").select("lid", "rid"))


def _short_part_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names of fewer than PART_GRAM characters inside longer ones: joined on the substrings of that length."""
    def tiny(names: DataFrame) -> DataFrame:
        return names.where(F.col("len") < PART_GRAM).select("nid", "name", "len")

    def pieces_of(names: DataFrame, k: int) -> DataFrame:
        cut = F.transform(F.sequence(F.lit(1), F.greatest(F.col("len") - k + 1, F.lit(1))), lambda i: F.substring(F.col("name"), i, k))
        return names.where(F.col("len") >= k * S.LONGER).select("nid", F.explode(F.array_distinct(cut)).alias("name"))

    def pieces(names: DataFrame) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [pieces_of(names, k) for k in range(1, PART_GRAM)])

    one = tiny(left).select(F.col("nid").alias("lid"), "name").join(_shuffled(pieces(right).withColumnRenamed("nid", "rid")), "name")
    other = _shuffled(pieces(left).withColumnRenamed("nid", "lid")).join(tiny(right).select(F.col("nid").alias("rid"), "name"), "name")
    return one.select("lid", "rid").unionByName(other.select("lid", "rid"))


# --- candidates by grams ----------------------------------------------------------------------------
def _grams(names: DataFrame, *keep: str) -> DataFrame:
    """(nid, form, grams): padded 2-grams of the words, numbered where they repeat; names with repeated words also without these (form 1)."""
    w = S.words(F.col("name"))
    forms = F.when(F.size(w) == F.size(F.array_distinct(w)), F.array(w)).otherwise(F.array(w, F.array_distinct(w)))
    by_form = names.select("nid", *keep, F.posexplode(forms).alias("form", "words"))
    of_word = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 3 - GRAM), lambda i: F.substring(F.concat(F.lit(" "), w, F.lit(" ")), i, GRAM))
    in_order = by_form.select("nid", *keep, "form", F.array_sort(F.flatten(F.transform("words", of_word))).alias("g"))
    number = lambda x, i: F.struct(x.alias("gram"), (i + 2 - F.array_position("g", x)).cast("int").alias("occ"))
    return in_order.where(F.size("g") > 0).select("nid", *keep, "form", F.transform("g", number).alias("grams"))


def _gram_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs whose names may be within the left one's ``edits`` insertions and deletions; left: nid, name, len, edits; right: nid, name, len.

    All but GRAM * edits of the grams of either name are shared, so of the GRAM * edits + TOGETHER rarest ones TOGETHER are: names with
    grams enough are joined on every choice of so many, which few pairs share by chance; the others on one of the GRAM * edits + 1 rarest.
    """
    reach = F.greatest(F.col("edits"), F.ceil(F.col("len") * (S.LONGER - 1)))
    low, high = left.agg(F.min(F.col("len") - reach), F.max(F.col("len") + reach)).first()
    levels = [r[0] for r in left.where(F.col("edits") <= MANY_EDITS).select("edits").distinct().collect()]
    plain_most = left.agg(F.max("edits")).first()[0]
    right = right.where(F.col("len").between(low, high))
    lg, rg = _grams(left, "len", "edits"), _grams(right.withColumn("edits", F.lit(0)), "len", "edits")
    of_gram = lambda x: _slot(x["gram"], x["occ"])
    counts = _gram_counts(of_gram, lg, rg)

    def ranked(index: DataFrame, a: str) -> DataFrame:
        """The grams of each name, those of the rarest slots first, as hashes: each name by itself, nothing is shuffled."""
        order = F.array_sort(F.transform("grams", lambda x: F.struct(_often(counts, of_gram(x)).alias("f"), x["gram"].alias("gram"), x["occ"].alias("occ"))))
        rows = index.select("nid", "form", "len", "edits", F.transform(order, lambda x: F.xxhash64(x["gram"], x["occ"])).alias("all"))
        return cut_lineage(rows.select(*[F.col(c).alias(a + c.replace("nid", "id")) for c in ("nid", "form", "len", "edits", "all")]))

    ls, rs = ranked(lg, "l"), ranked(rg, "r")
    many = F.col("ledits").isin(levels) & (F.size("lall") - GRAM * F.col("ledits") >= TOGETHER) if levels else F.lit(False)
    close = F.abs(F.col("llen") - F.col("rlen")) <= F.greatest(F.col("ledits"), F.col("llen") * (S.LONGER - 1))

    def chosen(names: DataFrame, a: str, edits: int) -> DataFrame:
        """A row per choice of TOGETHER of the first grams."""
        picks = itertools.combinations(range(GRAM * edits + TOGETHER), TOGETHER)
        rows = names.select(f"{a}id", f"{a}form", f"{a}len", f"{a}all", F.explode(F.array(*[F.array(*map(F.lit, p)) for p in picks])).alias("pick"))
        grams = [F.get(f"{a}all", F.get("pick", F.lit(k))) for k in range(TOGETHER)]
        return rows.where(F.get("pick", F.lit(TOGETHER - 1)) < F.size(f"{a}all")).select(
            F.xxhash64(F.lit(edits), *grams).alias("vh"), f"{a}id", f"{a}form", f"{a}len")

    parts, n_right = [], rs.count()
    for edits in levels:
        of = ls.where(many & (F.col("ledits") == edits))
        n = math.comb(GRAM * edits + TOGETHER, TOGETHER)
        lc, rc = _meeting(chosen(of, "l", edits), chosen(rs, "r", edits), n * of.count(), n * n_right)
        parts.append((lc.withColumn("ledits", F.lit(edits)), rc))
    few = ls.where(~many)
    if not few.isEmpty():
        first = lambda df, a, n: df.select(F.explode(F.slice(f"{a}all", F.lit(1), n)).alias("vh"), f"{a}id", f"{a}form", f"{a}len")
        lc = few.select(F.explode(F.slice("lall", F.lit(1), F.col("ledits") * GRAM + 1)).alias("vh"), "lid", "lform", "llen", "ledits")
        parts.append((lc, first(rs, "r", F.lit(plain_most * GRAM + 1))))
    near = functools.reduce(DataFrame.unionByName, [
        _shuffled(lc).join(_shuffled(rc), "vh").where(close).select("lid", "lform", "rid", "rform", "ledits") for lc, rc in parts]).distinct()
    # whole gram sets: all but the spoiled ones must be shared
    both = (_shuffled(near).join(_shuffled(ls.select("lid", "lform", "lall")), ["lid", "lform"])
            .join(_shuffled(rs.select("rid", "rform", "rall")), ["rid", "rform"]))
    common = F.size(F.array_intersect("lall", "rall"))
    return both.where(common >= F.greatest(F.size("lall"), F.size("rall")) - GRAM * F.col("ledits")).select("lid", "rid")


# --- the join ---------------------------------------------------------------------------------------
def _scored(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(lid, lname, rname, score); common: length of the longest common subsequence where deletions have found it, else null.

    Where the forms over words cannot give more than the common subsequence does, that is the score; only other pairs go to Python.
    """
    named = (_shuffled(pairs).join(_shuffled(right.select(F.col("nid").alias("rid"), F.col("name").alias("rname"))), "rid")
             .join(_shuffled(left.select(F.col("nid").alias("lid"), F.col("name").alias("lname"))), "lid")
             .groupBy("lid", "lname", "rname").agg(F.max("common").alias("common")))
    a, b = F.col("lname"), F.col("rname")
    total = F.length(a) + F.length(b)
    plain = F.lit(200.0) * F.col("common").cast("double") / total.cast("double")
    # equal hashes of unlike texts: the names are too far apart
    sure = (F.col("common").isNotNull() & (F.levenshtein(a, b) <= total - 2 * F.col("common")) & (S.length_factor(a, b) < S.LONGER)
            & (S.word_forms_most(a, b) <= plain))
    return named.where(sure).select("lid", "lname", "rname", plain.alias("score")).unionByName(
        named.where(~F.coalesce(sure, F.lit(False))).select("lid", "lname", "rname", S.weighted_ratio(a, b).alias("score")))


def _edits(length: Column, share: Column) -> Column:
    return F.floor(F.lit(2.0) * (F.lit(1.0) - share) * length / share + TINY).cast("int")


def _checked(threshold: float) -> float:
    if not LOWEST < threshold <= 100:
        raise ValueError(f"similarity {threshold}: candidates are complete over {LOWEST} only")
    return threshold / 100.0


def _union(parts: list[DataFrame | None]) -> DataFrame | None:
    parts = [p if "common" in p.columns else p.withColumn("common", F.lit(None).cast("int")) for p in parts if p is not None]
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def _by_grams(of: DataFrame, right: DataFrame, lengths: list[int], t: float) -> DataFrame | None:
    """Pairs that only grams find, of names (nid, name, len, least); none if every name has what it can have."""
    least = F.col("least") / 100.0 - TINY
    known = least > _best_missed(F.col("len"), lengths, t) + TINY
    by_words = least / S.WORD_SCALE
    wanted = F.greatest(F.when(~known, _edits(F.col("len"), least)), F.when(by_words <= 1, _edits(F.col("len"), F.least(by_words, F.lit(1.0)))))
    # without edits the sets of words are equal, and the pair is known by its words
    todo = cut_lineage(of.select("nid", "name", "len", wanted.alias("edits")).where(F.col("edits") > 0))
    return None if todo.isEmpty() else _gram_pairs(todo, right.select("nid", "name", "len"))


def similar_names(left_names: DataFrame, right_names: DataFrame, threshold: float) -> DataFrame:
    """(lname, rname, score) of all distinct pairs with a weighted ratio of ``threshold`` or more.

    Thresholds of 85.5 or less are refused: there a single shared word links names of unlike lengths.  Empty and null names link with nothing.
    """
    t = _checked(threshold)
    left, right = cut_lineage(_names(left_names).withColumn("least", F.lit(float(threshold)))), cut_lineage(_names(right_names))
    lengths = _lengths(left), _lengths(right)
    steps = list(itertools.product(range(DELETIONS + 1), repeat=2))
    parts = [_part_pairs(left, right, min(1.0, t / S.PART_SCALE)), _short_part_pairs(left, right)] if t <= S.PART_SCALE else []
    seeds = _union([_deletion_pairs(left, right, steps, lengths), _word_pairs(left, right, min(1.0, t / S.WORD_SCALE)), *parts,
                    _by_grams(left, right, lengths[1], t)])
    return _scored(seeds, left, right).select("lname", "rname", "score").where(F.col("score") >= threshold - TINY)


def subsequence_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(lname, rname) that may have a common-subsequence ratio of ``least`` or more; left: name, least (0 to 100); right: name.  Complete for any ``least`` over 0.

    By single characters, numbered where they repeat: a name keeps all but len (2 - 2 t) / (2 - t) of its characters in a partner, so
    of that many and one of its rarest ones one is shared.  The characters that both have must then reach the ratio.
    """
    def chars(names: DataFrame, share: Column) -> DataFrame:
        n = names.where(F.length("name") >= 1).select(F.col("name"), F.length("name").alias("len"), share.alias("share"))
        one = n.select("name", "len", "share", F.explode(F.split("name", "")).alias("c")).where(F.col("c") != "")
        counted = one.groupBy("name", "len", "share", "c").agg(F.count("*").cast("int").alias("n"))
        numbered = counted.select("name", "len", "share", "c", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
        return numbered.select("name", "len", "share", F.concat("c", F.col("i").cast("string")).alias("token"))

    lowest = left.agg(F.min("least")).first()[0]
    if lowest is None:
        return left.sparkSession.createDataFrame([], "lname string, rname string")
    lc, rc = chars(left.groupBy("name").agg(F.min("least").alias("least")), F.col("least") / 100.0), chars(right.distinct(), F.lit(lowest / 100.0))
    seen = lc.select("token").unionByName(rc.select("token")).groupBy("token").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("name").orderBy("f", "token"))
    all_of = lambda index, a: index.groupBy("name").agg(F.collect_list("token").alias(f"{a}all")).withColumnRenamed("name", f"{a}name")

    def prefix(index: DataFrame) -> DataFrame:
        spare = F.floor(F.col("len") * (2 - 2 * F.col("share")) / (2 - F.col("share")) + TINY)
        return index.join(seen, "token").withColumn("rank", rank).where(F.col("rank") <= spare + 1)

    lp, rp = prefix(lc).alias("l"), prefix(rc).alias("r")
    total = F.col("l.share") * (F.col("l.len") + F.col("r.len"))
    pairs = (lp.join(rp, (F.col("l.token") == F.col("r.token")) & (2 * F.least(F.col("l.len"), F.col("r.len")) >= total - TINY))
             .select(F.col("l.name").alias("lname"), F.col("r.name").alias("rname"), total.alias("total")).distinct())
    both = pairs.join(all_of(lc, "l"), "lname").join(all_of(rc, "r"), "rname")
    return both.where(2 * F.size(F.array_intersect("lall", "rall")) >= F.col("total") - TINY).select("lname", "rname")


def best_similar(left_names: DataFrame, right_names: DataFrame, threshold: float) -> DataFrame:
    """(lname, rname, score): the best partner of each left name; of equal ones the shortest, then the last by name.

    From the best that a name can have downwards: itself, then partners with its words or two deletions away, then three and four,
    then the parts, then the grams.  After each step only the names go on that the next one may give a partner as good as theirs.
    """
    t = _checked(threshold)
    # the better one of equally good partners has the higher rank
    ranked = _names(right_names).orderBy(F.desc("len"), "name").withColumn("rank", F.monotonically_increasing_id())
    left, right = cut_lineage(_names(left_names)), cut_lineage(ranked)
    same = left.join(right.select("nid", F.col("name").alias("rname")), "nid").where(F.col("name") == F.col("rname"))
    done = [same.select("nid", F.col("name").alias("lname"), "rname", F.lit(100.0).alias("score"))]
    # each step's names are written: the plans would hold all the steps before, on the driver
    left = cut_lineage(left.join(same.select("nid"), "nid", "left_anti").withColumn("least", F.lit(float(threshold))))
    lengths = _lengths(left), _lengths(right)

    def step(*parts: DataFrame | None) -> None:
        """Takes the best of the scored pairs; from here on a name's partner must be as good as that."""
        nonlocal left
        parts = [p.select("lid", "lname", "rname", "score") for p in parts if p is not None]
        if not parts:
            return
        best = F.max(F.struct("score", (-F.length("rname")).alias("l"), "rname")).alias("b")
        found = cut_lineage(functools.reduce(DataFrame.unionByName, parts).groupBy("lid", "lname").agg(best).where(F.col("b.score") >= threshold - TINY)
                            .select(F.col("lid").alias("nid"), "lname", F.col("b.rname").alias("rname"), F.col("b.score").alias("score")))
        done.append(found)
        left = cut_lineage(left.join(_shuffled(found.select("nid", "score")), "nid", "left")
                           .withColumn("least", F.greatest("least", F.coalesce("score", F.lit(0.0)))).drop("score"))

    def scored(*pairs: DataFrame | None) -> DataFrame | None:
        some = _union(list(pairs))
        return None if some is None else _scored(some, left, right)

    step(_deletion_best(left, right, [s for s in STEPS if sum(s) <= 2], lengths), scored(_word_pairs(left, right, min(1.0, t / S.WORD_SCALE))))
    for lost in (3, 4):
        step(_deletion_best(left, right, [s for s in STEPS if sum(s) == lost], lengths))
    if t <= S.PART_SCALE:
        # all that parts can give
        open_ = left.where(F.col("least") <= 100.0 * S.PART_SCALE + TINY)
        step(scored(_part_pairs(open_, right, min(1.0, t / S.PART_SCALE)), _short_part_pairs(open_, right)))
    step(scored(_by_grams(left, right, lengths[1], t)))
    rows = functools.reduce(DataFrame.unionByName, done)
    best = rows.groupBy("lname").agg(F.max(F.struct("score", (-F.length("rname")).alias("l"), "rname")).alias("b"))
    return best.select("lname", F.col("b.rname").alias("rname"), F.col("b.score").alias("score"))
