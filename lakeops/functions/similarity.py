"""Similarity of names as Columns: common-subsequence ratio, its forms over words, and the weighted ratio made of them.

All scores run from 0 to 100.  The ratio of two texts is 200 * LCS / (sum of their lengths), LCS being the length of the longest common
subsequence.  Spark has no such function, and array lambdas cannot express its recurrence without a lambda call per pair of characters, so LCS
runs in an Arrow batch: one row of the table of all pairs of a batch at a time, in numpy.  What goes around it is built-in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

CELLS = 1 << 20  # characters of pairs that are compared at a time
WORD_SCALE = 0.95  # of scores that ignore the order of words
PART_SCALE, FAR_PART_SCALE = 0.9, 0.6  # of scores of a part of the longer text, and where that is over FAR times as long
LONGER, FAR = 1.5, 8.0


def _codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, np.int32)
    for row, t in zip(out, texts, strict=True):
        row[: len(t)] = np.frombuffer(t.encode("utf-32-le"), "<i4")
    return out


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    swap = [len(x) > len(y) for x, y in zip(a, b, strict=True)]
    short, long = [y if s else x for x, y, s in zip(a, b, swap, strict=True)], [x if s else y for x, y, s in zip(a, b, swap, strict=True)]
    out = np.zeros(len(short), np.int32)
    order = sorted(range(len(short)), key=lambda i: (len(short[i]), len(long[i])))
    at = 0
    while at < len(order):
        end, width = at, 0
        while end < len(order) and (end == at or (end + 1 - at) * max(1, len(short[order[end]])) <= CELLS):
            width = max(width, len(short[order[end]]))
            end += 1
        rows = order[at:end]
        x = _codes([short[i] for i in rows], width, -1)
        y = _codes([long[i] for i in rows], max(len(long[i]) for i in rows), -2)
        best = np.zeros((len(rows), width + 1), np.int32)
        for j in range(y.shape[1]):
            # row j of each table: from above, or from above left and one more; then the best so far from the left
            np.maximum(best[:, 1:], best[:, :-1] + (x == y[:, j : j + 1]), out=best[:, 1:])
            np.maximum.accumulate(best, axis=1, out=best)
        out[rows] = best[:, -1]
        at = end
    return out


def partial_scores(a: list[str], b: list[str]) -> list[float]:
    """Best ratio of the shorter text with a window of the longer: of its own length, or shorter at either end."""
    out = []
    for x, y in zip(a, b, strict=True):
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        m, n = len(short), len(long)
        if not m:
            out.append(100.0 if not n else 0.0)
        elif short in long:
            out.append(100.0)
        else:
            windows = [long[:i] for i in range(1, m)] + [long[i : i + m] for i in range(n)]
            scores = [0.0]
            for k in range(0, len(windows), 4096):
                part = windows[k : k + 4096]
                scores.append(max(200.0 * c / (m + len(w)) for c, w in zip(lcs_lengths([short] * len(part), part).tolist(), part, strict=True)))
            out.append(max(scores))
    return out


@F.pandas_udf(IntegerType())
def _lcs(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series(lcs_lengths(a.fillna("").tolist(), b.fillna("").tolist()))


@F.pandas_udf(DoubleType())
def _partial(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series(partial_scores(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")


def _share(common: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * common.cast("double") / F.greatest(total, F.lit(1)).cast("double"))


def subsequence_ratio(a: Column, b: Column) -> Column:
    """200 * LCS / (length of a + length of b); two empty texts are equal; null counts as empty."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return _share(_lcs(a, b), F.length(a) + F.length(b))


def words(a: Column) -> Column:
    """The words of a text (between spaces), in order."""
    return F.array_sort(F.filter(F.split(F.coalesce(a, F.lit("")), " "), lambda w: w != ""))


def sorted_words(a: Column) -> Column:
    return F.array_join(words(a), " ")


def word_sort_ratio(a: Column, b: Column) -> Column:
    """Ratio of the texts with their words in order."""
    return subsequence_ratio(sorted_words(a), sorted_words(b))


def word_set_ratio(a: Column, b: Column) -> Column:
    """Best ratio among: the shared words, those and the rest of a, those and the rest of b.  100 where one has all words of the other, 0 without words."""
    wa, wb = F.array_distinct(words(a)), F.array_distinct(words(b))
    shared = F.array_join(F.array_intersect(wa, wb), " ")
    rest_a, rest_b = F.array_join(F.array_except(wa, wb), " "), F.array_join(F.array_except(wb, wa), " ")
    some = F.when(shared != "", 1).otherwise(0)
    n = F.length(shared)
    full_a, full_b = n + some + F.length(rest_a), n + some + F.length(rest_b)
    # the shared words stand in front of both, so the distance is that of the rests
    distance = F.length(rest_a) + F.length(rest_b) - 2 * _lcs(rest_a, rest_b)
    both = F.lit(100.0) * (F.lit(1.0) - distance.cast("double") / F.greatest(full_a + full_b, F.lit(1)).cast("double"))
    one = lambda full: F.when(some == 1, _share(n, n + full)).otherwise(F.lit(0.0))
    return (F.when((F.size(wa) == 0) | (F.size(wb) == 0), F.lit(0.0)).when((some == 1) & ((rest_a == "") | (rest_b == "")), F.lit(100.0))
            .otherwise(F.greatest(both, one(full_a), one(full_b))))


def word_forms_most(a: Column, b: Column) -> Column:
    """What the forms over words give the weighted ratio at most, for texts of like lengths: by built-in functions alone.

    The distance in insertions and deletions is never under the Levenshtein distance.
    """
    wa, wb = words(a), words(b)
    sa, sb = F.array_join(wa, " "), F.array_join(wb, " ")
    in_order = F.lit(1.0) - F.levenshtein(sa, sb) / F.greatest(F.length(sa) + F.length(sb), F.lit(1))
    wa, wb = F.array_distinct(wa), F.array_distinct(wb)
    shared = F.array_join(F.array_intersect(wa, wb), " ")
    rest_a, rest_b = F.array_join(F.array_except(wa, wb), " "), F.array_join(F.array_except(wb, wa), " ")
    n, some = F.length(shared), F.when(shared != "", 1).otherwise(0)
    full_a, full_b = n + some + F.length(rest_a), n + some + F.length(rest_b)
    both = F.lit(1.0) - F.levenshtein(rest_a, rest_b) / F.greatest(full_a + full_b, F.lit(1))
    one = lambda full: F.lit(2.0) * n / F.greatest(n + full, F.lit(1))
    whole = (some == 1) & ((rest_a == "") | (rest_b == ""))
    return F.lit(100.0 * WORD_SCALE) * F.greatest(in_order, F.when(whole, F.lit(1.0)).otherwise(F.greatest(both, one(full_a), one(full_b))))


def partial_ratio(a: Column, b: Column) -> Column:
    """Best ratio of the shorter text with a part of the longer."""
    return _partial(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def length_factor(a: Column, b: Column) -> Column:
    """Length of the longer text over that of the shorter."""
    return F.greatest(F.length(a), F.length(b)).cast("double") / F.greatest(F.least(F.length(a), F.length(b)), F.lit(1)).cast("double")


def weighted_ratio(a: Column, b: Column) -> Column:
    """The best of the plain ratio and, scaled down, the forms over words; for texts of very unlike lengths the forms over parts.  Empty texts: 0.

    The forms over parts are evaluated only for the pairs that need them.
    """
    factor = length_factor(a, b)
    near = F.greatest(subsequence_ratio(a, b), F.lit(WORD_SCALE) * F.greatest(word_sort_ratio(a, b), word_set_ratio(a, b)))
    scale = F.when(factor <= FAR, PART_SCALE).otherwise(FAR_PART_SCALE)
    apart = factor >= LONGER
    # a UDF is evaluated for all rows of a branch: the rows that do not need it give it empty texts
    only = lambda c: F.when(apart, c).otherwise(F.lit(""))
    wa, wb = words(a), words(b)
    shared = F.arrays_overlap(wa, wb)
    by_words = F.when(shared, F.lit(100.0)).otherwise(F.greatest(partial_ratio(only(sorted_words(a)), only(sorted_words(b))),
                                                                 partial_ratio(only(F.array_join(F.array_distinct(wa), " ")), only(F.array_join(F.array_distinct(wb), " ")))))
    far = F.greatest(subsequence_ratio(a, b), scale * partial_ratio(only(a), only(b)), F.lit(WORD_SCALE) * scale * by_words)
    return F.when((F.coalesce(F.length(a), F.lit(0)) == 0) | (F.coalesce(F.length(b), F.lit(0)) == 0), F.lit(0.0)).when(apart, far).otherwise(near)
