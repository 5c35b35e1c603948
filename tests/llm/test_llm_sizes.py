"""What the operators send and hold."""

import numpy as np

from lakeops.llm import substring_dedup
from lakeops.llm.words import Hasher, word_chunks


def test_suffixes_leave_out_the_words_of_their_anchor():
    """Same key, same anchor: only the words around it are sent; windows are told apart by each of them."""
    kind = substring_dedup.Suffixes.kind()
    around = substring_dedup.WINDOW - substring_dedup.ANCHOR
    assert kind["words"].shape == (2 * around,) and kind.itemsize <= 212
    rows = np.zeros(4, kind)
    rows["key"], rows["near"], rows["far"] = [7, 7, 7, 8], 0, around
    rows["words"] = np.arange(2 * around) + 1
    rows["words"][1, -1] = 99  # differs in the last word: only the window that starts with the anchor reaches it
    rows["words"][2, 0] = 98  # in the first one: only the window that ends with the anchor does
    rows["c1"] = np.arange(4)
    whole = (1 << (around + 1)) - 1
    assert substring_dedup.repeated_windows(rows).tolist() == [whole, whole & ~1, whole & ~(1 << around), 0]


def test_suffixes_of_a_repeated_passage(spark):
    import pyarrow as pa

    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"a b c {passage} d"), (2, f"e {passage} f g"), (3, passage.replace("w20", "x"))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in got.collect()} == {1: 40, 2: 40, 3: 0}
    (_, _, _, _, w), = word_chunks(Hasher(), pa.array([passage]))
    assert len(substring_dedup.Anchors(Hasher(), w).keys)


def test_token_files_are_as_many_as_the_texts_ask_for(spark, tmp_path, monkeypatch):
    """Many shuffle partitions make many ranges, but few files; all ids follow each other in order."""
    import public_tokenizers

    from lakeops.llm import token_file

    docs = spark.createDataFrame([(i * 37 % 401, f"text number {i} " * (i % 5)) for i in range(401)], "doc_id long, text string").repartition(7)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    reports = []
    for bytes_, partitions in ((1 << 24, "40"), (1 << 11, "40"), (1 << 24, "1")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        monkeypatch.setattr(token_file, "FILE_BYTES", bytes_)
        path = tmp_path / f"{bytes_}-{partitions}"
        try:
            token_file.write_tokens(docs, str(path), tokenizer, end_id=2, shard_tokens=64)
            n = len(list(path.glob("*.parquet")))
            assert n == 1 if bytes_ == 1 << 24 else 1 < n <= 8
            assert spark.read.parquet(str(path)).select("part").distinct().count() > (30 if partitions == "40" else 0)
            reports.append(sorted(token_file.document_report(spark, str(path)).collect()))
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert reports[0] == reports[1] == reports[2] and [r.doc_id for r in reports[0]] == list(range(401))
    at = 0
    for r in reports[0]:
        assert r.start == at
        at += r.n_tokens


def test_signs_after_letters_are_coded_apart():
    """``word$$$`` is ``word`` and ``$$$``: no spelling of its own to learn; ids are the library's, special tokens too."""
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from lakeops.llm import token_file

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, plain = token_file.WordTokenizer(path), Tokenizer.from_file(path)
    learned = []
    real = tok.coder.learn
    tok.coder.learn = lambda data, sizes: learned.append(len(sizes)) or real(data, sizes)
    words = ["zorp", "glim", "trask"]
    texts = [f"{w}{s}" for w in words for s in ("", "$$$", "###", "***", "%", "@", "&&&", "_", "(", ">")]
    assert [len(i) for i in (plain.encode(t, add_special_tokens=False).ids for t in texts)] == tok.counts(pa.array(texts)).tolist()
    assert sum(learned) == len(words) + 9
    odd = ["don't we'll I'M 'tis o'clock's", "a<|endoftext|>b c<|EndOfText|>d x<|startoftext|>", "a|b a||b|c <|endoftext|<|endoftext|>", "e$́ é$ a≮b á*b",
           "É$$$ ß% ç_ x_y__z a@b.c-d/e\\f", "x'S'T y'' z'3 a\"b\"c [a]{b}(c) a~b`c^d", "A#b#C+=d", "don’t a…. İ* kK#"]
    ids = [list(flat[firsts[i] : firsts[i + 1]]) for flat, firsts in tok.encode(pa.array(odd)) for i in range(len(firsts) - 1)]
    assert ids == [plain.encode(t, add_special_tokens=False).ids for t in odd]
