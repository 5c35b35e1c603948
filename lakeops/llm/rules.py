"""Quality rules learned as a decision list (sequential covering, grown and pruned).

Rules for the *bad* class are learned one after the other: each is grown on two
thirds of the labelled rows left, one threshold condition at a time by FOIL
information gain, then pruned from its end on the other third, and kept only
while its precision there stays above a floor.  Rows that it covers leave the
table and the next rule is learned.  The list is emitted as one ordered
``CASE WHEN`` of Spark columns, so applying it is plain JVM code.

Edge cases: no labelled rows, one class only or no useful condition give an empty
list, which keeps every document.  A ratio whose denominator is zero is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.stats import text_stats

# ratio features: name -> (numerator, denominator); plain counts have no denominator
FEATURES: dict[str, tuple[str, str | None]] = {
    "n_words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "word_chars"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "digit_ratio": ("n_digits", "word_chars"),
    "punct_ratio": ("n_punct", "word_chars"),
    "stutter_ratio": ("n_stutter", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str  # "<=" or ">"
    threshold: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v <= self.threshold if self.op == "<=" else v > self.threshold

    def column(self) -> Column:
        v = feature_column(self.feature)
        return v <= F.lit(self.threshold) if self.op == "<=" else v > F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {self.op} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    support: int
    precision: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        m = np.ones(len(next(iter(x.values()))), bool)
        for c in self.conditions:
            m &= c.mask(x)
        return m

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def feature_column(name: str) -> Column:
    num, den = FEATURES[name]
    n = F.col(num).cast("double")
    return n if den is None else F.when(F.col(den) > 0, n / F.col(den)).otherwise(F.lit(0.0))


def features(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The same ratios over numpy columns."""
    out = {}
    for name, (num, den) in FEATURES.items():
        n = counts[num].astype(float)
        out[name] = n if den is None else np.divide(n, counts[den], out=np.zeros(len(n)), where=counts[den] > 0)
    return out


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """FOIL gain of covering p positives and n negatives instead of p0 and n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _best_condition(x, bad, quantiles: int):
    best, best_gain = None, 1e-9
    p0, n0 = float(bad.sum()), float((~bad).sum())
    for name, v in x.items():
        order = np.argsort(v, kind="stable")
        s, b = v[order], bad[order]
        cuts = np.unique(np.quantile(s, np.linspace(0, 1, quantiles + 1)[1:-1], method="inverted_cdf"))
        at = np.searchsorted(s, cuts, "right")
        below_p = np.concatenate([[0], np.cumsum(b)])[at].astype(float)
        below_n = at - below_p
        for op, p, n in (("<=", below_p, below_n), (">", p0 - below_p, n0 - below_n)):
            g = _gain(p, n, p0, n0)
            i = int(np.argmax(g)) if len(g) else -1
            if i >= 0 and g[i] > best_gain:
                nxt = s[min(at[i], len(s) - 1)]
                # midway to the next value, so that the cut does not sit on a training row
                best, best_gain = Condition(name, op, float((cuts[i] + nxt) / 2 if nxt > cuts[i] else cuts[i])), g[i]
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, *, max_rules: int = 16, max_conditions: int = 4,
          min_precision: float = 0.9, min_support: int = 5, quantiles: int = 64, seed: int = 7) -> list[Rule]:
    """Sequential covering of the bad rows; ``min_precision`` is asked on the pruning third."""
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        idx = np.flatnonzero(left)
        if bad[idx].sum() < 3 * min_support or (~bad[idx]).sum() == 0:
            break
        third = rng.random(len(idx)) < 1 / 3
        gx, gb = {k: v[idx[~third]] for k, v in x.items()}, bad[idx[~third]]
        px, pb = {k: v[idx[third]] for k, v in x.items()}, bad[idx[third]]
        conds: list[Condition] = []
        rows = np.ones(len(gb), bool)
        while len(conds) < max_conditions and gb[rows].any() and not gb[rows].all():
            c = _best_condition({k: v[rows] for k, v in gx.items()}, gb[rows], quantiles)
            if c is None:
                break
            conds.append(c)
            rows &= c.mask(gx)
        if not conds:
            break

        def worth(cs):
            m = Rule(tuple(cs), 0, 0.0).mask(px)
            p, n = int(pb[m].sum()), int((~pb[m]).sum())
            return (p - n) / (p + n) if p + n else -1.0, p, n

        # prune: drop final conditions while that does not lower (p - n) / (p + n)
        while len(conds) > 1 and worth(conds[:-1])[0] >= worth(conds)[0]:
            conds.pop()
        _, p, n = worth(conds)
        if p < min_support or p / (p + n) < min_precision:
            break
        rule = Rule(tuple(conds), p, p / (p + n))
        rules.append(rule)
        left &= ~rule.mask(x)
    return rules


def rule_columns(rules: list[Rule]) -> tuple[Column, Column]:
    """(number of the first rule that fires, 0 if none; whether the document is kept)."""
    number = F.lit(0)
    if rules:
        number = F.when(rules[0].column(), F.lit(1))
        for i, r in enumerate(rules[1:], 2):
            number = number.when(r.column(), F.lit(i))
        number = number.otherwise(F.lit(0))
    return number, number == 0


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, good_value: int = 1, **options) -> list[Rule]:
    """Learn from at most ``sample_rows`` labelled documents (those with the lowest id hash).

    ``labels``: doc_id and quality; several labels of a document count as bad if one of them is.
    Only their statistics come to the driver: sample_rows x 10 numbers at most.
    """
    picked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min((F.col("quality") == good_value).cast("int")).alias("good"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi")
    rows = text_stats(sample).join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "n_words")
    pdf = rows.limit(4 * sample_rows).toPandas()
    if not len(pdf):
        return []
    return learn(features({c: pdf[c].to_numpy() for c in pdf.columns}), (pdf["good"] == 0).to_numpy(), **options)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The fixed base rule: under 10 words, or over 20 % of them in repeated 5-word windows."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics, base rule and the list's verdict for every document."""
    number, verdict = rule_columns(rules)
    return (text_stats(docs)
            .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
            .withColumn("rule", number)
            .withColumn("kept", ~F.col("base_failed") & verdict))
