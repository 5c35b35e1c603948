"""Secret scan: fixed patterns, and password guess cost of values in a credential context.

Fixed patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost and
non-overlapping per kind; a match that is too short is dropped, not retried.
A value that stands where a credential would (after ``pwd:``, ``bearer``,
``client key =`` and the like) has no shape of its own, so it is judged by how
many guesses it takes: dynamic programming over its characters finds the cheapest
segmentation into dictionary words (also reversed or in leet spelling), dates,
repeats, sequences, keyboard walks and brute-force spans.  Values at or above
``min_log10_guesses`` become spans of kind ``guess``, unless a fixed span already
covers all of them.  After a bare space (no ``:``, ``=`` or ``is``) words in their usual case
are prose, not values.  A value that becomes none is read again, as it may be the keyword of the next
one (``Authorization: Bearer ...``); a keyword itself is never a secret.

The dictionary is ``WORDS``, or the list that is given: the queries add the whole words of a public tokenizer's vocabulary, whose
ids order them by use (``vocabulary_words``), so that an ordinary word after ``token:`` or ``is`` costs its rank and is no secret.

Offsets are code points, end exclusive.  Null text counts as empty and has no
spans.  Rows are independent: repeated rows give repeated results.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.words import releasing

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# equal to the runs of AKIA[A-Z0-9]+ of 20 characters or more and of [0-9a-f]+ of 24 or more:
# either pattern takes a run to its end, so a run that is too short has no later start that is long enough
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEYWORD = (r"""(?:pwd|pass(?:word|wd|phrase|code)?|secret|token|credentials?|(?:api|access|private|client|auth|session|signing|account)"""
           r"""[_\x20-]?(?:key|secret|token|pass|pwd|id)|authorization|bearer|basic)""")
CONTEXT = KEYWORD + r"""["']?\x20*(?:(?P<told>[:=]|\x20is\x20)|\x20)\x20*["']?(?P<value>[!-&(-~]{6,})"""
# words in their usual case, as prose has them after a keyword and a bare space
PROSE = re.compile(r"[(\[{<\"]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-/.,:;&_()\[\]\"]+(?:[A-Z]?[a-z]+|[A-Z]+))*")

# FIXED VALUES: common password words, most used first (the rank is the guess count)
WORDS = """password admin welcome secret letmein login user test master hello qwerty dragon monkey football baseball
sunshine princess iloveyou shadow superman trustno pass root guest changeme example token key access default demo
summer winter spring autumn january february march april june july august september october november december monday
tuesday wednesday thursday friday saturday sunday love money freedom computer internet server database system service
public private client api auth bearer none null true false your here placeholder insert redacted hidden enter value""".split()
# FIXED VALUES: keyboard rows; neighbours are in the same row or the row below
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@3105$7!", "aaeiosstl")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
SEGMENT_COST = 0.3  # log10 of the choice among segment boundaries, per segment
MAX_WORD = 16


def vocabulary_words(path: str, *, word_end: str = "</w>", least: int = 4) -> list[str]:
    """``WORDS``, then the whole words (``least`` letters or more) of a tokenizer file in the order of their ids.

    The list is as long as the vocabulary at most, whatever the corpus; it is read in the driver and sent with the tasks.
    """
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = [t.removesuffix(word_end) for t in sorted(vocab, key=vocab.get) if t.endswith(word_end)]
    return list(dict.fromkeys([*WORDS, *(w for w in ends if len(w) >= least and w.isascii() and w.isalpha())]))


def neighbours() -> dict[str, str]:
    """Keys that touch each key: left and right, two in the row above, two in the row below."""
    at = {(r, i): c for r, row in enumerate(ROWS) for i, c in enumerate(row)}
    steps = ((0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0))
    return {c: "".join(at.get((r + dr, i + di), "") for dr, di in steps) for (r, i), c in at.items()}


class GuessCost:
    """log10 of the guesses that the cheapest segmentation of a value takes."""

    def __init__(self, words: list[str] | None = None):
        words = WORDS if words is None else words
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.next_to = neighbours()
        self.cost = lru_cache(maxsize=50_000)(self._cost)

    @staticmethod
    def _classes(value: str) -> int:
        return (10 * any(c.isdigit() for c in value) + 26 * any(c.islower() for c in value)
                + 26 * any(c.isupper() for c in value) + 33 * any(not c.isalnum() for c in value)) or 1

    def _runs(self, value: str, step) -> list[int]:
        """For each position, the end of the run from there in which ``step(a, b)`` holds for neighbours."""
        n = len(value)
        out = [n] * n
        for i in range(n - 2, -1, -1):
            out[i] = out[i + 1] if step(value[i], value[i + 1]) else i + 1
        return out

    def _matches(self, value: str):
        """(start, end, log10 guesses) of the non-brute-force segments."""
        n, low = len(value), value.lower()
        plain = low.translate(LEET)
        for i in range(n):
            for j in range(i + 3, min(n, i + MAX_WORD) + 1):
                for form, extra in ((low, 0.0), (plain, 0.5)):
                    w = form[i:j]
                    rank = self.rank.get(w) or 2 * self.rank.get(w[::-1], 0)
                    if rank:
                        yield i, j, math.log10(rank) + extra + (0.3 if value[i:j] != low[i:j] else 0.0)
                        break
        for m in DATE.finditer(value):
            years = 100 if m.end() - m.start() == 4 else 100 * 365 * (4 if m[1] or m[2] else 1)
            yield m.start(), m.end(), math.log10(years)
        for m in re.finditer(r"(.{1,8}?)\1+", value, re.S):
            unit = m[1]
            each = min(len(unit) * math.log10(self._classes(unit)), math.log10(self.rank.get(unit.lower(), 10**9)))
            yield m.start(), m.end(), each + math.log10((m.end() - m.start()) // len(unit))
        for step in (1, -1):
            for i, j in enumerate(self._runs(value, lambda a, b: ord(b) - ord(a) == step and b.isalnum())):
                if j - i >= 3:
                    yield i, j, math.log10(40 * (j - i))
        for i, j in enumerate(self._runs(low, lambda a, b: b in self.next_to.get(a, ""))):
            if j - i >= 3:
                turns = sum(1 for k in range(i + 2, j) if ord(low[k]) - ord(low[k - 1]) != ord(low[k - 1]) - ord(low[k - 2]))
                yield i, j, math.log10(47 * (j - i)) + 0.6 * min(turns, j - i - 2) / 2

    def _cost(self, value: str) -> float:
        n = len(value)
        if n == 0:
            return 0.0
        char = math.log10(self._classes(value))
        ending: dict[int, list[tuple[int, float]]] = {}
        for i, j, c in self._matches(value):
            ending.setdefault(j, []).append((i, c))
        # best[i]: cheapest cover of value[:i]; brute[i]: the same with a brute-force span that ends at i
        best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
        for j in range(1, n + 1):
            brute[j] = min(brute[j - 1], best[j - 1] + SEGMENT_COST) + char
            best[j] = min([brute[j], *(best[i] + SEGMENT_COST + c for i, c in ending.get(j, ()))])
        return best[n]


class Scanner:
    """Spans (kind, start, end, log10 guesses or None) of one text."""

    def __init__(self, min_log10_guesses: float, words: list[str] | None = None):
        self.assign = re.compile(ASSIGN, re.I | re.A)
        self.access, self.hex = re.compile(ACCESS), re.compile(HEX)
        self.context, self.keyword = re.compile(CONTEXT, re.I | re.A), re.compile(KEYWORD, re.I | re.A)
        self.least, self.guess = min_log10_guesses, GuessCost(words)

    def base(self, text: str) -> list[tuple[str, int, int, float | None]]:
        out = []
        if ":" in text or "=" in text:
            out += [("assign", m.start(), m.end(), self.guess.cost(m[2])) for m in self.assign.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [("access", m.start(), m.end(), None) for m in self.access.finditer(text)]
        out += [("hex", m.start(), m.end(), None) for m in self.hex.finditer(text)]
        return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))

    def added(self, text: str, base) -> list[tuple[str, int, int, float]]:
        out, at, cheap = [], 0, -1
        while m := self.context.search(text, at):
            a, b = m.span("value")
            # the value may be the keyword of the value that follows it, so it is read again unless it became a span
            at, end = a, b
            value = m["value"].partition('"')[0] if text[a - 1] == '"' else m["value"]  # a quoted value ends with its quote
            b = a + len(value.rstrip(".,;:!?\"')]}>"))
            if b - a < 6 or any(s <= a and b <= e for _, s, e, _ in base) or self.keyword.fullmatch(text, a, b):
                continue
            if not m["told"] and PROSE.fullmatch(text, a, b):
                continue
            # the end of a value takes no more guesses than the value
            if end == cheap:
                continue
            cost = self.guess.cost(text[a:b])
            if cost >= self.least:
                out.append(("guess", a, b, cost))
                at = end
            else:
                cheap = end
        return out

    def __call__(self, text: str):
        base = self.base(text)
        return sorted(base + self.added(text, base), key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = "array<struct<kind:string,start:long,end:long,log10_guesses:double>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_log10_guesses: float = 10.0,
                 words: list[str] | None = None) -> DataFrame:
    """(doc_id, spans) for each input row, spans ordered by start and kind."""
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = part.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())])

    def scan(batches):
        scanner = Scanner(min_log10_guesses, words)
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "log10_guesses"), s, strict=True)) for s in scanner(t or "")] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(item))], names=["doc_id", "spans"])

    return part.mapInArrow(releasing(scan), f"doc_id {kind}, spans {SPANS}")


def redacted(docs: DataFrame, text_col: str = "text", *, min_log10_guesses: float = 10.0, words: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with all of their columns, each stretch of the text that spans cover replaced by ``[kind]``.

    Overlapping and touching spans are one stretch, named after its first span.  A null text stays null.
    """

    def scan(batches):
        scanner = Scanner(min_log10_guesses, words)
        for batch in batches:
            texts = [masked(t, found) if t and (found := scanner(t)) else t for t in batch.column(text_col).to_pylist()]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(releasing(scan), docs.schema)


def masked(text: str, spans) -> str:
    """The text with each stretch covered by spans replaced by [kind] of the stretch's first span."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b, _ = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] <= b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[at:a], f"[{kind}]"]
        at = b
        i += 1
    return "".join(out) + text[at:]


def span_list(spans, kinds: tuple[str, ...] = KINDS):
    """Column kind:start:end of the spans of these kinds, comma-joined in their order."""
    keep = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast(T.LongType())
