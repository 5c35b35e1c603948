"""Small tables with the awkward rows that every operator must take."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# extra columns whose names clash with columns that operators make inside or return
CLASHING = ("n_words", "kept", "cls", "n", "hits", "mask", "block", "score", "spans", "cluster", "n_tokens", "start", "at", "sha", "doc", "shard", "a", "b")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts(seed=5, n=120):
    """Prose of few words, near copies, shared passages, repeated lines; then the odd ones."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    out = []
    for i in range(n):
        body = [rng.choice(vocab) for _ in range(rng.randrange(3, 120))]
        if i % 6 == 1 and out:
            body = (out[-1] or "").split()
            for _ in range(max(1, len(body) // 60)):
                body[rng.randrange(len(body))] = "changed"
        text = " ".join(body)
        if i % 9 == 2:
            text += "\n" + passage
        if i % 11 == 3:
            text = (text + ".\n") * 3
        out.append(text)
    return out + [None, "", " \t\n", "one", "one", "Two words", "a b c d", "A B c d", "x " * 300, "...", "1234 5678", "🙂 ▁ ▁▁  é́ <|endoftext|> <|ENDOFTEXT|> <s>",
                  " ".join(vocab * 40), passage, passage, passage.upper(), "password = hunter2long and token: abc", "z" * 30_000]


def rows(seed=5):
    got = texts(seed)
    langs = ["en", "de", None]
    return [(i, t, langs[i % 3], None if i % 7 == 0 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(got)]


def documents(spark, seed=5, repeated=True, clashing=False):
    """The table; ``repeated``: some rows occur again, and two rows have a null id."""
    data = rows(seed)
    if repeated:
        data = data + data[3:6] + [(None, "no id here", "en", "src0", 10), (None, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    if clashing:
        for i, c in enumerate(CLASHING):
            df = df.selectExpr("*", f"'extra {i}' AS {c}")
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
