"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Sources share the total size by their weights.  A source whose share is over ``max_epochs`` times its own size is clamped
there, and what it leaves is shared again among the others, until no share is over its cap.  The words a source then
gives are whole repetitions of all of its documents and, for the rest, one seeded draw: its documents stand in the
order of a hash of seed, id and size, and are taken as long as the rest lasts; the one at the border is taken in
part (its first words), so that a source gives its target to the word.

How it is split: texts are measured in one scan, and only ids and sizes go on.  A source's documents are dealt into buckets
of the hash, some square root of the number of documents in all; bucket sums (pre-aggregated) give the size
before each bucket, and only inside its bucket is a document set against others.  So neither a source with most rows
nor the table itself meets in one task; the clamping loop sees one row of sums a round.

A null text has size 0, a null source is a source of its own (the last one).  Rows of one id are documents of their own; rows
that are equal in id, source and size may change places in the order, which changes no result.  Where all
sizes are 0, so are all targets.  An empty table gives an empty result.  A text of any length is measured whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.staging import staged
from lakeops.operators.projection import add_seq_key

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
KEY_DIGITS, KEY_BITS = 15, 60  # hex digits of an MD5, and their bits


def word_count(text):
    """Number of words of a text: each word becomes one letter, white space goes."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "w"), SPACE, "")), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: Sequence[str], seed: int) -> DataFrame:
    """doc_id, source, size, place (the seeded order) and the carried columns."""
    part = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col).cast("string")).alias("size"), *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    return part.withColumn("place", F.conv(F.substring(F.md5(name), 1, KEY_DIGITS), 16, 10).cast("long"))


def weighted(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Adds ``weight`` to (unnamed, name, ...): the weights in turn, by the code points of the name, null last."""
    # the place of a source in the order, without all sources in one task
    numbered = add_seq_key(sources, "nth", ["unnamed", "name"])
    turn = ((F.col("nth") - 1) % len(weights) + 1).cast("int")
    return numbered.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), turn).cast("long")).drop("nth")


def water_filled(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (..., source_size, weight): its share of the sum of all sizes, clamped at max_epochs times its size.

    Each round clamps what is over its cap and shares the excess by weight.  A round brings one row of sums to the
    driver.  A round that clamps nothing is the last, so there are at most as many as sources, and mostly a few.
    """
    cap = F.col("source_size") * max_epochs
    share = None  # (words, weights): what the sources that are not clamped get, and their weights
    while True:
        # exact in integers: clamped where words * weight / weights >= cap
        over = F.lit(False) if share is None else F.lit(share[0]).cast("decimal(38,0)") * F.col("weight") >= cap * F.lit(share[1])
        got = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, cap).otherwise(0)).alias("clamped"),
                          F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weights")).first()
        now = ((got["all"] or 0) - (got["clamped"] or 0), got["weights"] or 0)
        if now == share or not now[1]:
            break
        share = now
    if not now[1]:  # all are clamped (or there are none)
        return sources.withColumn("target", cap.cast("double"))
    free = F.lit(float(share[0])) * F.col("weight") / F.lit(float(share[1]))
    return sources.withColumn("target", F.when(over, cap.cast("double")).otherwise(free))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: Sequence[int] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, whole, part, taken, and carry_0, carry_1, ...

    ``whole``: times that all of it is taken; ``part``: words taken once more (0, its size, or less at the border);
    taken = whole * size + part.  Equal input and seed give equal rows.  Other columns are read only if carried.
    """
    rows = staged(sized(docs, id_col, text_col, source_col, carry, seed), "mix-sizes")
    buckets = 1 << min(20, max(0, math.isqrt(rows.count()).bit_length() - 1))
    # a null source by a mark and no name, so that joins and windows deal by the same plain keys
    key = ["unnamed", "name", "bucket"]
    rows = rows.select(F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name"),
                       F.shiftright("place", KEY_BITS - buckets.bit_length() + 1).cast("int").alias("bucket"), *rows.columns)
    sums = staged(rows.groupBy(*key).agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    sources = staged(weighted(sums.groupBy("unnamed", "name").agg(F.sum("bucket_size").alias("source_size")), weights), "mix-sources")
    # in whole words: as many as the target is near to, of them whole repetitions, and the rest
    plan = (water_filled(sources, max_epochs).withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
            .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size")))
    by_place = Window.partitionBy("unnamed", "name").orderBy("bucket")
    before = sums.select(*key, (F.sum("bucket_size").over(by_place) - F.col("bucket_size")).alias("before"))
    planned = staged(before.join(plan, ["unnamed", "name"]).select(*key, "before", "source_size", "target", "whole", "rest"), "mix-plan")
    within = Window.partitionBy(*key).orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(planned, key)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead"))).cast("long")
    out = placed.withColumn("ahead", ahead).withColumn("part", part).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    return out.select("doc_id", "source", "size", "source_size", "target", "whole", "part", "taken", *(f"carry_{i}" for i in range(len(carry))))


def repetitions(mixed: DataFrame, text: str = "carry_0") -> DataFrame:
    """The texts of the mixture: a row for each repetition (``epoch``, from 1) of each document of ``mix(..., carry=("text",))``.

    A document taken in part has its first ``part`` words, joined by one space.  Null and empty texts give no row.
    """
    first = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), 0), F.lit(1), F.col("part").cast("int")), " ")
    all_ = mixed.filter("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0))))
    cut = (F.col("epoch") > F.col("whole")) & (F.col("part") < F.col("size"))
    return all_.select("doc_id", "source", "epoch", F.when(cut, first).otherwise(F.col(text)).alias("text"))


# The same rows by sorting and prefix sums: a source is clamped if its cap is under the share that is left when those with
# lower ratios of size to weight are clamped.
ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
placed AS (
  SELECT *, md5('20240229:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR) AS place FROM sizes),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sums),
ordered AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER w, 0) AS caps_below, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights_left
  FROM weighted WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, (total - caps_below) * weight >= cap * weights_left AS clamped FROM ordered),
free AS (
  SELECT (min(total) - coalesce(sum(cap) FILTER (clamped), 0))::DOUBLE AS words, (sum(weight) FILTER (NOT clamped))::DOUBLE AS weights FROM marked),
targets AS (
  SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE words * weight / weights END AS target FROM marked, free),
plans AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole FROM targets),
ahead AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM placed)
SELECT a.doc_id, a.source, a.size, p.source_size, p.target, p.whole::BIGINT AS whole,
       greatest(0, least(a.size, p.words - p.whole * p.source_size - a.ahead))::BIGINT AS part,
       (p.whole * a.size + greatest(0, least(a.size, p.words - p.whole * p.source_size - a.ahead)))::BIGINT AS taken
FROM ahead a JOIN plans p ON a.source IS NOT DISTINCT FROM p.source
"""
