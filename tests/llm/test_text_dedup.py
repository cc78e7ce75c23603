"""Substring dedup, SimHash groups and line dedup against brute force."""

import hashlib
import random

import pytest
import xxhash

from tillworks.llm import graph, lines, queries, simhash, substring

SCHEMA = "doc_id bigint, text string, source string, line int, id string, marks string, carried string"


def table(spark, rows, schema=SCHEMA):
    """Rows of (doc_id, text, source), with further columns of names that the operators use."""
    return spark.createDataFrame([(i, t, s, 7, "x", None, "y") for i, t, s in rows], schema).repartition(3)


def random_rows(seed, n, words=12):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = [rng.choice("abcdef") for _ in range(rng.randint(0, words * 6))]
        if rows and rng.random() < 0.4:
            base = rng.choice(rows)[1].split()
            at = rng.randint(0, len(base))
            text = text[: rng.randint(0, 9)] + base[at : at + 30] + text[9:]
        rows.append((i * 3, rng.choice([" ", "  ", "\t", "\n"]).join(text), f"s{rng.randint(0, 4)}"))
    return rows


ODD = [
    (1001, None, "s1"),
    (1002, "", None),
    (1003, " \n\t ", "s2"),
    (1004, "one", "s1"),
    (1005, "long " * 30_000, "s2"),
    (1006, "long " * 20_000, "s3"),
    (1007, "ünï ÇØ dé " * 20, "s1"),
    (1008, "ünï ÇØ dé " * 20, "s1"),
]


def cut_by_hand(rows, width):
    first, out = {}, {}
    split = [(i, (t or "").encode().split()) for i, t, _ in rows if i is not None]
    for i, words in sorted(split, key=lambda r: r[0]):
        for k in range(len(words) - width + 1):
            first.setdefault(tuple(words[k : k + width]), i)
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("width", [3, 7])
def test_repeated_passages(spark, width):
    rows = random_rows(width, 120) + ODD
    got = substring.remove_repeated_passages(table(spark, rows), width).collect()
    found = {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got
    }
    assert len(got) == len(rows) and found == cut_by_hand(rows, width)
    for r in got:
        assert sum(s.length for s in r.removed) == r.n_removed
        ends = [(s.start, s.start + s.length) for s in r.removed]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))  # maximal spans


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e", "s"), (5, "a b c d e", "s"), (None, "a b c d e", "s"), (9, "x a b c", "s")]
    got = substring.remove_repeated_passages(table(spark, rows), 3).collect()
    kept = sorted(((r.doc_id or -1), r.kept_text) for r in got)
    assert kept == [(-1, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (9, "x")]


def test_empty_tables(spark):
    none = table(spark, [])
    assert substring.remove_repeated_passages(none).count() == 0
    assert simhash.near_groups(none).count() == 0
    assert lines.remove_boilerplate(none).count() == 0


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words[k : k + 3] for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    prints = [(i, print_by_hand(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in prints:
        for j, b in prints:
            if i < j and (a ^ b).bit_count() <= 3 and find(i) != find(j):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (f"{p:016x}", find(i)) for i, p in prints}


def test_near_groups(spark):
    rng = random.Random(4)
    rows = list(ODD)
    for i in range(60):
        base = [rng.choice(["the", "of", "Ab", "cd", "xyz"]) + str(rng.randint(0, 50)) for _ in range(200)]
        for k in range(rng.choice([1, 1, 3])):
            edited = list(base)
            for _ in range(k):
                edited[rng.randrange(200)] = "new"
            rows.append((i * 10 + k, " ".join(edited), "s"))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(table(spark, rows)).collect()}
    assert got == groups_by_hand(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_near_groups_of_many_near_fingerprints(monkeypatch):
    """A large group of one signature is split, and loses no link."""
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, dtype=np.uint64)
    prints = {int(base)}
    while len(prints) < 400:
        bits = rng.integers(0, 64, size=rng.integers(1, 5))
        flip = np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64))
        prints.add(int(base ^ flip))
    prints = np.array(sorted(prints), dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    want = simhash._roots(len(prints), *np.nonzero(near))
    for pairwise, tile in ((64, 1024), (4, 16)):
        monkeypatch.setattr(simhash, "_PAIRWISE", pairwise)
        monkeypatch.setattr(simhash, "_TILE", tile)
        assert (simhash._links_in_large_run(prints) == want).all()


def test_same_ids_and_null_ids_in_groups(spark):
    rows = [(4, "a b c d", "s"), (4, "a b c d", "s"), (None, "a b c d", "s"), (None, "other words here", "s")]
    got = [(r.doc_id, r.component_id) for r in simhash.near_groups(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(4, 4), (4, 4), (None, 4), (None, None)], key=str)


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 60)]
    star = [(100, k) for k in range(101, 160)]
    edges = spark.createDataFrame(chain + star + star + [(7, 7), (None, 3), (500, 400)], "a bigint, b bigint")
    got = dict(tuple(r) for r in graph.connected_components(edges).collect())
    want = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)} | {400: 400, 500: 400}
    assert got == want
    assert graph.connected_components(edges.where("a = 0")).count() == 0


def test_components_end_with_stars(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "stored", lambda df, keep=graph.stored: rounds.append(df) or keep(df))
    stars = [(9, 2), (2, 7), (5, 3), (3, 5), (None, 4), (6, 6)]
    edges = spark.createDataFrame(stars, "a bigint, b bigint")
    got = sorted(tuple(r) for r in graph.connected_components(edges).collect())
    assert got == [(2, 2), (3, 3), (5, 3), (7, 2), (9, 2)] and len(rounds) == 1

    rng = random.Random(4)
    for ends, n in ((40, 30), (60, 90)):
        pairs = [(rng.randrange(ends), rng.randrange(ends)) for _ in range(n)]
        root = {x: x for pair in pairs for x in pair}
        for _ in root:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        got = dict(tuple(r) for r in graph.connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
        assert got == {x: root[x] for x in linked}


def lines_by_hand(rows, least):
    blank = " \t\r\v\f"
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if key := line.strip(blank):
                sites.setdefault(key, set()).update({site} - {None})
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    out = []
    for i, text, _ in rows:
        split = text.split("\n") if text is not None else []
        solid = [k for k, line in enumerate(split) if line.strip(blank)]
        gone = {
            k
            for k in solid
            if i is not None and len(sites[split[k].strip(blank)]) >= least and first[split[k].strip(blank)] < i
        }
        kept = None if text is None else "\n".join(x for k, x in enumerate(split) if k not in gone)
        out.append((i, len(solid), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 4])
def test_lines(spark, least):
    rng = random.Random(least)
    pool = ["menu", " menu", "menu\t", "rights reserved", "é", "", "  ", *[f"line {k}" for k in range(30)]]
    rows = [
        (i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9))), rng.choice(["a", "b", "c", "d", "e", None]))
        for i in range(80)
    ]
    rows += [(None, "menu\nown", "f"), (200, None, "a"), (201, "", "b"), (202, "x\n" * 50_000 + "menu", "c")]
    got = lines.remove_boilerplate(table(spark, rows), least).collect()
    assert sorted((tuple(r) for r in got), key=str) == lines_by_hand(rows, least)


def test_line_carries_columns(spark):
    got = lines.remove_boilerplate(table(spark, [(1, "a", "s")]), 2, carry=["line", "carried", "marks"]).first()
    assert got.carried.asDict() == {"line": 7, "carried": "y", "marks": None}


def test_op1_and_op6_on_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1(spark, sf_dir).collect()}
    assert got == cut_by_hand(rows, 50)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6(spark, sf_dir).collect()}
    assert got == groups_by_hand(rows)
