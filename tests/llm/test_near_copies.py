"""Near copies of the pipeline: groups by similarity of 5-word shingles, against brute force."""

import random

import corpus_pipeline
import numpy as np
import pytest
from tillworks.llm import nearcopies, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def groups_by_hand(texts, least=0.8):
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in texts.items():
        for j, b in texts.items():
            if i < j and find(i) != find(j) and similarity(a, b) >= least:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in texts}


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def random_texts(seed, bases, copies, words=150):
    rng, texts = random.Random(seed), {}
    for _ in range(bases):
        base = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(copies):
            texts[len(texts) * 3] = edited(rng, base, rng.choice([0, 1, 2, 3, 4]))
    return texts


def table(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_the_stage_drops_copies_that_differ_in_many_bits(spark, sf_dir):
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(231)]
    while True:
        copy = edited(rng, base, 4)
        apart = simhash.fingerprint(copy.encode()) ^ simhash.fingerprint(" ".join(base).encode())
        if apart.bit_count() > 6:
            break
    other = edited(rng, base, 40)
    assert similarity(" ".join(base), copy) >= 0.8 > similarity(" ".join(base), other)
    docs = table(spark, [(1, " ".join(base)), (2, copy), (3, other), (4, copy), (None, copy)])
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 3, None]


@pytest.mark.parametrize("bases, copies", [(60, 4), (2, 90)])
def test_groups_against_brute_force(spark, bases, copies):
    """The second table has groups that are larger than what is compared at once."""
    texts = random_texts(bases, bases, copies)
    texts |= {9001: None, 9002: " \n", 9003: "one", 9004: "ONE", 9005: "one two", 9006: "a b c d e"}
    got = nearcopies.near_copies(table(spark, texts.items())).collect()
    assert {r.doc_id: r.component_id for r in got} == groups_by_hand(texts)
    assert bases < len({r.component_id for r in got}) < len(texts)


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                if len(a & b) >= 0.8 * len(a | b):
                    assert got[i] == got[j]


def test_odd_rows(spark):
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "other words here"), (7, "A  b c d")]
    got = nearcopies.near_copies(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(4, 4), (4, 4), (None, 4), (None, None), (7, 4)], key=str
    )
    assert nearcopies.near_copies(table(spark, [])).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 140, 1500, 20000])
def test_sketches_tell_no_similar_sets_apart(size):
    rng = np.random.default_rng(size)
    for turn in range(60):
        x = rng.integers(0, 2**64, size, dtype=np.uint64)
        # Sets at the limit: a share of one is left out, or taken out of both on different places.
        gone = rng.integers(0, size // 5 + 1) if turn % 2 else size // 5
        a, b = (x, x[gone:]) if turn % 3 else (x[gone // 2 :], x[: size - gone // 2])
        similar = len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        told = nearcopies.may_reach(nearcopies.odd_sketch(a)[None], nearcopies.odd_sketch(b)[None], 0.8)
        assert told[0] or not similar
    other = rng.integers(0, 2**64, size, dtype=np.uint64)
    if size <= 140:
        assert not nearcopies.may_reach(
            nearcopies.odd_sketch(x)[None], nearcopies.odd_sketch(other)[None], 0.8
        )[0]


def test_a_large_family_under_the_limit_gives_few_pairs(spark, monkeypatch):
    """300 texts of one family, about 0.66 alike, with a few near copies among them."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    texts = {k: edited(rng, base, 4) for k in range(300)}
    for k in range(0, 300, 50):
        texts[1000 + k] = edited(rng, texts[k].split(), 1)
    late = []
    near_pairs = nearcopies._near_pairs

    def counted(members, least=None):
        found = near_pairs(members, least)
        if least is not None:
            late.append(found.count())
        return found

    monkeypatch.setattr(nearcopies, "_near_pairs", counted)
    got = nearcopies.near_copies(table(spark, texts.items())).collect()
    assert {r.doc_id: r.component_id for r in got} == groups_by_hand(texts)
    assert late and late[0] < 3 * len(texts)
