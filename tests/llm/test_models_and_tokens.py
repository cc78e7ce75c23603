"""Language ID, quality, token counts and packing: libraries, held-out rows and odd input."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillworks.llm import language, packing, quality, queries, tokencount

PIECES = queries.tokenizer("piece_bpe_32k.model")
WORDS = queries.tokenizer("word_bpe_49k.json")
ALPHABET = list("ab  \n\t▁é'<|>s0.,日ß") + ["the", " the", "'s", "  ", "Words", "\r\n", "\x1c", "　"]
ODD = [
    None, "", " ", "   ", "\n", " \n ", "▁", "▁ x", " ▁x", "a▁b ▁ c", "<s> </s> <unk> <0x0A>",
    "<|endoftext|>hi<|startoftext|>", "don't I'll 'S", "\x00\x01a\x1cb\x85c", "é é ΣΑΣ. İ ſ",
    "日本語 テスト", "😀😀  😀", "﻿bom", "x " * 40_000, "y" * 5_000,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    return ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 50))) for _ in range(200)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "own", 3, "z") for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, ids string, task int, slice string"
    return spark.createDataFrame(rows, schema).repartition(3).checkpoint()


def test_token_counts(docs, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: tuple(r)[1:] for r in tokencount.token_counts(docs, PIECES, limit=4096).collect()}
    for i, text in enumerate(texts):
        n = len(model.encode(text or ""))
        assert got[i] == (len((text or "").encode()), n, n > 4096), repr(text)[:80]


def test_repeated_rows_are_counted_each(spark):
    rows = [(1, "a b c")] * 3 + [(None, "a b c"), (None, None)]
    got = tokencount.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), PIECES)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == [("1", 3)] * 3 + [("None", 0), ("None", 3)]


def check_pieces(pieces, wanted, length):
    """Pieces give back each document's ids, and fill the sequences without a gap."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert by_doc.keys() == wanted.keys()
    for doc, ids in wanted.items():
        own = sorted(by_doc[doc], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == np.array(ids, dtype="<u4").tobytes()
        assert all(p.doc_tokens == len(ids) for p in own)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for name, spans in by_sequence.items():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) == length or name == len(by_sequence) - 1


@pytest.mark.parametrize("length", [64, 4096])
def test_packing(docs, texts, length):
    model = Tokenizer.from_file(WORDS)
    wanted = {i: model.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    check_pieces(packing.pack(docs, WORDS, length).collect(), wanted, length)


def test_packing_forgets_words_when_there_are_many(monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 3)
    encode, kind = packing.encoder(WORDS)
    model = Tokenizer.from_file(WORDS)
    for text in ("a b c d e", "a b", "f g h i", "a f"):
        want = np.array(model.encode(text, add_special_tokens=False).ids, dtype=kind)
        assert encode([text]) == [want.tobytes()]


def test_packing_query_digests(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in packing.pack(docs, WORDS).collect()}
    got = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op8(spark, sf_dir).collect()}
    assert got == want


def test_no_rows(spark, docs):
    none = docs.where("doc_id < 0")
    assert packing.pack(none, WORDS).count() == 0
    assert tokencount.token_counts(none, PIECES).count() == 0
    model = language.fit(none.withColumn("lang", F.lit("en")))
    assert language.predict(none, model).count() == 0
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    trees = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, label int"))
    assert quality.score(none, trees).count() == 0
    assert {r.score for r in quality.score(docs, trees).collect()} == {0.5}


def test_language_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = queries.op3(spark, sf_dir).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 20 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_language_of_odd_texts(spark, docs):
    train = spark.createDataFrame(
        [(1, "the and of the", "en"), (2, "le la de les", "fr"), (3, None, "en"), (4, "the", None)],
        "doc_id bigint, text string, lang string",
    )
    model = language.fit(train)
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "a"), (5, "THE and OF, the!"), (6, "de les"), (None, "les les")]
    got = [
        (r.doc_id, r.lang_pred, r.score > 0)
        for r in language.predict(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    ]
    assert got[:3] == [(k, "und", False) for k in (1, 2, 3)]
    assert got[3][1] in ("en", "fr")
    assert [g[1] for g in got[4:]] == ["en", "fr", "fr"]
    scores = [r.score for r in language.predict(docs, model).collect()]
    assert 0 <= min(scores) and max(scores) <= 1


def test_long_texts_are_cut_where_grams_end():
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcé1.") for _ in range(rng.randint(1, 9))) for _ in range(n))
             for n in (300, 1, 0, 40)] + [None, "x" * 500]
    whole, owner = language.text_grams(texts[:5])
    seen = []
    for rows, parts in language.pieces(texts[:5], 50):
        assert max(map(len, parts)) <= 50
        grams, of = language.text_grams(parts)
        seen += zip(rows[of].tolist(), grams.tolist())
    assert sorted(seen) == sorted(zip(owner.tolist(), whole.tolist()))
    cut = [p for _, parts in language.pieces(texts, 50) for p in parts]
    assert "".join(cut) == "".join(t or "" for t in texts)


def test_blocks_of_grams_are_the_grams_of_the_whole():
    texts = ["Ab, c", None, "", "xyzé  été 12 Σa", ".", "日本語 テスト", "a"]
    wanted = []
    for row, text in enumerate(texts):
        kept = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        kept = " " + " ".join(kept.split()) + " "
        for n in (3, 4):
            grams = [kept[i : i + n] for i in range(len(kept) - n + 1)]
            wanted += [row for g in grams if " " not in g[1:-1]]
    whole, owner = language.text_grams(texts)
    assert sorted(owner.tolist()) == wanted
    for block in (1, 2, 5, 1000):
        found = list(language.gram_blocks(texts, block))
        pairs = [x for grams, of in found for x in zip(of.tolist(), grams.tolist())]
        assert sorted(pairs) == sorted(zip(owner.tolist(), whole.tolist()))
        assert all(len(of) <= 2 * block for _, of in found)


def test_language_works_on_blocks_of_bounded_memory():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(4000)) for _ in range(100)]
    column, names = pa.array(texts), ["lang", "text"]
    labelled = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), column], names=names)
    model = language.build_filter(["en"], np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    ids = pa.array(range(len(texts)), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, column, ids], names=["doc_id", "text", "carried"])
    for work in (language._counted([labelled]), language._predict([rows], model)):
        tracemalloc.start()
        try:
            for _ in work:
                pass
            assert tracemalloc.get_traced_memory()[1] < 60 << 20
        finally:
            tracemalloc.stop()


def test_filter_answers_for_all_languages():
    rng = np.random.default_rng(1)
    names = [f"l{k}" for k in range(70)]  # more than one word of bits
    grams = [rng.integers(0, 1 << 63, 300, dtype=np.uint64) for _ in names]
    found = language.build_filter(names, np.concatenate(grams), np.repeat(np.arange(70), 300))
    for k, own in enumerate(grams):
        bit = (found.masks(own)[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
        assert bit.all()
    other = found.masks(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    share = [np.mean((other[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(70)]
    assert abs(np.mean(share) - found.wrong.mean()) < 1e-3


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest table has too few labels
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = queries.op4(spark, sf_dir).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) for r in got)


def test_flat_trees_follow_their_cuts():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.2) ^ (x[:, 7] > 0)).astype(float)
    trees = quality.fit_trees(x, y, trees=30)

    def by_hand(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] + (row[trees.feature[node]] > trees.cut[node])
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x[:50]), [by_hand(r) for r in x[:50]])
    assert np.mean((trees.score(x) > 0.5) == y) > 0.95


def test_statistics_of_odd_texts(texts):
    for text in texts:
        values = quality.statistics(text or "")
        assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()
