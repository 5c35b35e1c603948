"""Token files, SentencePiece, packing: against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import llm_cases as C
from lakeops.llm import packing, piece_bpe, token_file
from lakeops.llm.staging import shared_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("bits", [4, 8, 12, 16])
def test_codes_give_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2 ** rng.integers(1, 33, 3000))
    shard = token_file.Shard(token_file.write_shard([7, None, 9], np.array([0, 10, 10, 3000]), ids, bits))
    at = rng.permutation(3000)
    assert (shard.take(at) == ids[at]).all()
    assert shard.doc_ids == [7, None, 9] and (shard.document(2) == ids[10:]).all() and not len(shard.document(1))


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(1)
    bits = ["the", "A", " ", "\n", "é", "é", "ing", "梦", "🙂", "\x00x", "<|endoftext|>", "<|ENDOFTEXT|>", "0", "12", "'s", "\x85", "　", "İ", "Σ", "a.", "é.", "’.", "b,."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for _ in range(2000)] + C.texts()
    coder, library = token_file.WordTokenizer(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    got = []
    for flat, firsts in coder.encode(pa.array(texts, pa.string())):
        got += [flat[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("shard_tokens", [1, 500, 1 << 18])
def test_token_file_round_trip(spark, shard_tokens):
    docs = C.documents(spark, clashing=True)
    path = shared_path(spark, "test-tokens")
    token_file.write_tokens(docs, path, WORD_BPE, end_id=2, shard_tokens=shard_tokens)
    got = [tuple(r) for r in token_file.document_report(spark, path).orderBy("start").collect()]
    library = Tokenizer.from_file(WORD_BPE)
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [g[0] for g in got] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i))
    start = 0
    for doc_id, at, n, crc in got:
        assert at == start
        want[doc_id].remove((n, crc))
        start += n
    assert not any(want.values())


def test_token_file_of_an_empty_table(spark):
    path = shared_path(spark, "test-tokens")
    token_file.write_tokens(C.empty(spark), path, WORD_BPE, end_id=2)
    assert token_file.document_report(spark, path).count() == 0


def test_pieces_match_the_library():
    rng = random.Random(2)
    bits = ["the", "a", " ", "  ", "\n", "é", "▁", "ing", "梦", "🙂", "\x00x", "<s>", "</s>", "0", "12", " t", "́"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 80))) for _ in range(2000)] + C.texts()
    coder = piece_bpe.Encoder(PIECES)
    ids, written, agrees = coder.encode(pa.array(texts, pa.string()))
    want = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode([t or "" for t in texts])
    assert ids == want and written == [",".join(map(str, w)) for w in want] and agrees.all()


def test_heap_and_array_agendas_agree():
    model = piece_bpe.PieceModel(PIECES)
    segments = [" " + w for w in sorted({w for t in C.texts() for w in C.words(t)}) if len(w) < 60]
    sym = [model.symbol_of[[ord(c) for c in s]].astype(np.int32) for s in segments]
    flat, count = model.merge_many(np.concatenate(sym), np.array([len(s) for s in sym]))
    assert [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])] == [model.merge_heap(s.tolist()) for s in sym]


def test_piece_operator(spark):
    docs = C.documents(spark, clashing=True)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(((r.doc_id, r.ids, r.n_tokens, r.decoded, r.agrees) for r in piece_bpe.encode(docs, PIECES).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, ",".join(map(str, ids)), len(ids), library.decode(ids), True))
    assert got == sorted(want, key=str)
    assert piece_bpe.encode(C.empty(spark), PIECES).count() == 0


def slow_best_fit(pieces, capacity):
    """The rule without an index: the least residual that holds the piece in a compatible bin."""
    bins = []
    for size, source, cluster in pieces:
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and b["left"] > 0 and not (source and source in b["s"]) and not (cluster and cluster in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        bins[i]["left"] -= size
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
        yield i


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(3)
    pieces = sorted([(rng.randrange(1, 60), 1 << rng.randrange(5), 1 << rng.randrange(40)) for _ in range(600)], reverse=True)
    bins = packing.Bins(100)
    assert [bins.place(*p)[0] for p in pieces] == list(slow_best_fit(pieces, 100))


def test_packing(spark):
    docs = C.documents(spark, clashing=True)
    n = docs.count()
    sized = packing.measured(docs, WORD_BPE)
    got = packing.best_fit(sized, n, capacity=64, group_docs=50).toPandas()
    total = sized.toPandas()
    assert got.n_tokens.sum() == total.n_tokens.sum() and len(total) == n
    assert got.groupby("bin").n_tokens.sum().max() <= 64
    shared = got[got.n_tokens > 0]
    assert not shared[shared.source.notna()].duplicated(["bin", "source"]).any()
    assert not shared[shared.cluster.notna()].duplicated(["bin", "cluster"]).any()
    ordered = got.sort_values(["bin", "position"])
    ends = (ordered.position + ordered.n_tokens).shift()
    assert ((ordered.bin != ordered.bin.shift()) | (ordered.position == ends)).all()
    assert packing.best_fit(packing.measured(C.empty(spark), WORD_BPE), 0).count() == 0


def test_near_copies_never_share_a_bin(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        texts += [" ".join(words)] * 2 + [" ".join([*words[:-i], *(f"n{rng.randrange(5000)}" for _ in range(i))]) for i in (1, 2, 3)] + [" ".join(words[:50])]
    rows = [(None if i % 9 == 4 else i // 2 if i % 9 == 5 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(d, t, f"src{i}") for i, (d, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    got = packing.best_fit(packing.measured(docs, WORD_BPE), len(texts)).toPandas()
    at = {r.source: r.bin for r in got.itertuples()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]
    assert len(near) > 12 * 10 and len(got) == len(texts) > got.bin.nunique()
    assert not [(i, j) for i, j in near if at[f"src{i}"] == at[f"src{j}"]]


def test_packing_of_odd_lengths(spark):
    sized = spark.createDataFrame([(1, 0, "a", None), (2, None, "a", 5), (None, 7, None, None), (4, -3, None, 5), (5, 130, "a", 5)], "doc_id long, n_tokens long, source string, cluster long")
    got = packing.best_fit(sized, 5, capacity=64).toPandas()
    assert got.groupby("doc_id", dropna=False).n_tokens.sum().sort_values().tolist() == [0, 0, 0, 7, 130]
