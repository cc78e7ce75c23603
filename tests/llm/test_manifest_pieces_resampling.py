"""The Merkle manifest, merge-type encoding and importance resampling against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillworks.llm import mergepieces, merkle, queries, resampling
from tillworks.llm.numbering import numbered

MODEL = queries.tokenizer("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, place int, n int, tree string, carried int"


def table(spark, rows):
    """Rows of (doc_id, text, source), with further columns of names that the operators use."""
    return spark.createDataFrame([(i, t, "en", s, 1, 3, 4, "x", 5) for i, t, s in rows], SCHEMA).repartition(3)


def written(spark, rows, folder):
    """A data folder with these documents, for registered queries."""
    table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# --- numbering -------------------------------------------------------------------------------


def test_places_within_groups(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "a", "a", "b", None, "é"])) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, g string").repartition(5)
    got = numbered(df, [F.col("k")], ["g"]).collect()
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    want, first = {}, {}
    for at, (k, g) in enumerate(ordered):
        first.setdefault(g, at)
        want[k] = (at - first[g], first[g], sum(1 for r in rows if r[1] == g))
    assert {r.k: (r.place, r.first, r.n) for r in got} == want
    assert numbered(df.limit(0), [F.col("k")]).count() == 0


# --- Merkle manifest -------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = (row.doc_id, row.source, row.lang, row.n_chars, row.text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(levels, place):
    """The root, and the siblings of the leaf at ``place`` on the way up."""
    siblings = []
    for level in levels[:-1]:
        run = place // 16 * 16
        siblings += [d for k, d in enumerate(level[run : run + 16], run) if k != place]
        place //= 16
    return siblings


def grown(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[k : k + 16]) for k in range(0, len(below), 16)])
    return levels


def manifest_by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[name] = grown([leaf(r) for r in groups[name]])
    top = grown([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for place, row in enumerate(groups[name]):
            proof = climb(trees[name], place) + climb(top, at)
            touched = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), row.text or "")
            out.append(
                (row.doc_id, leaf(row), trees[name][-1][0], top[-1][0], digest(*proof), not (touched and lowered != (row.text or "")))
            )
    return out


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16, 17, 1], [300, 2, 33] + [1] * 20])
def test_manifest_against_brute_force(spark, tmp_path, sizes):
    ids = itertools.count(5)
    names = [None, "b", "é", "a", ""] + [f"s{k}" for k in range(40)]
    rows = [(next(ids), random.Random(k).choice(["Aa", "bb", "", None, "éÉ Z" * 50]), names[s])
            for s, n in enumerate(sizes) for k in range(n)]
    folder = written(spark, rows, tmp_path)
    got = queries.QUERIES["op12_merkle_manifest"](spark, folder).collect()
    want = manifest_by_hand(table(spark, rows).collect())
    key = lambda r: str(r[0])
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got), key=key) == sorted(want, key=key)
    assert all(r.verified == (r.folded_root == r.root) for r in got)


def test_manifest_of_odd_rows(spark, tmp_path):
    rows = [(None, "No Id", "a"), (None, "No Id", "a"), (5, "X" * 200_000, "a"), (5, "X" * 200_000, "a"), (7, None, None)]
    got = queries.QUERIES["op12_merkle_manifest"](spark, written(spark, rows, tmp_path / "t")).collect()
    want = manifest_by_hand(table(spark, rows).collect())
    assert sorted(map(str, ((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got))) == sorted(map(str, want))
    empty = queries.QUERIES["op12_merkle_manifest"](spark, written(spark, [], tmp_path / "e"))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_any_change_is_found(spark):
    leaves = spark.range(1000).select("id", F.lit("g").alias("g"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    shown = leaves.withColumn("shown", F.when(F.col("id") == 417, F.unhex(F.sha2(F.lit("other"), 256))).otherwise(F.col("digest")))
    none = F.when(F.col("id") == 3, F.lit(None)).otherwise(F.col("shown"))
    built = merkle.build(shown.withColumn("shown", none), "g", [F.col("id")], fan_out=4)
    got = merkle.verify(spark, built, "shown").collect()
    assert {r.id for r in got if not r.verified} == {3, 417}
    assert len(got) == 1000 and {r.root for r in got} == {built.root}
    plan = spark.read.parquet(f"{built.folder}/nodes")
    assert plan.where("up_tree is null").count() == 1


# --- merge-type pieces -----------------------------------------------------------------------


def random_text(rng):
    text = "".join(rng.choice("  \n\tabcdesthion▁<>0x1é漢字ñ😀²\x00\r,.") for _ in range(rng.randint(0, 50)))
    if rng.random() < 0.3:
        text = text.replace("a", " " * rng.randint(1, 40))
    return text + rng.choice(["", "", "<s></s><unk><0x0A> Hello, world", "the " * 5, "İstanbul Straße"])


def test_encoding_and_decoding_against_the_library(spark):
    rng = random.Random(5)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(k, random_text(rng), "s") for k in range(3000)]
    rows += [(-1, None, "s"), (-2, "", None), (-3, " ", "s"), (None, "no id", "s"), (-4, "ab" * 50_000 + " " * 30_000, "s"), (-4, "twice", "s"), (-4, "twice", "s")]
    docs = table(spark, rows)
    coded = mergepieces.encode(docs, MODEL, carry=["text", "place"])
    got = coded.collect()
    assert len(got) == len(rows) and {r.carried.place for r in got} == {3}
    for r in got:
        assert r.ids == library.encode(r.carried.text or ""), r
    for r in mergepieces.decode(coded, MODEL, carry=["ids"]).collect():
        assert r.text == library.decode(r.carried.ids)
    assert mergepieces.encode(table(spark, []), MODEL).count() == 0


def test_decoding_of_any_ids(spark):
    rng = random.Random(6)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    kinds = [lambda: rng.randint(0, 2), lambda: rng.randint(3, 258), lambda: rng.randint(0, 31999), lambda: 259]
    lists = [[rng.choice(kinds)() for _ in range(rng.randint(0, 8))] for _ in range(3000)]
    df = spark.createDataFrame([(k, ids) for k, ids in enumerate([*lists, None])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in mergepieces.decode(df, MODEL).collect()}
    assert got == {k: library.decode(ids) for k, ids in enumerate(lists)} | {len(lists): None}
    with pytest.raises(Exception, match="outside the vocabulary"):
        mergepieces.decode(df.select("doc_id", F.array(F.lit(32000)).alias("ids")), MODEL).collect()


def test_merging_and_backtracking_agree():
    encoder = mergepieces.Encoder(mergepieces.Pieces(MODEL))
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("▁▁aeinorst") for _ in range(rng.randint(1, 24)))
        assert [encoder._tokens[t] for t in encoder.tokens(text)] == encoder.merged(text)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        mergepieces.Pieces(str(path))


def test_round_trip_query(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op11_sentencepiece_round_trip"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids))


# --- importance resampling -------------------------------------------------------------------


def features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return words, [zlib.crc32(f.encode()) % 10000 for f in runs]


def resampled_by_hand(rows, target):
    split = [(i, *features(t)) for i, t, _ in rows]
    raw, aim = [0] * 10000, [0] * 10000
    for counts, found in ((raw, [f for _, _, f in split]), (aim, [features(t)[1] for t in target])):
        for bucket in itertools.chain(*found):
            counts[bucket] += 1
    gain = [
        math.floor(1000 * math.log((t + 1) * (sum(raw) + 10000) / ((s + 1) * (sum(aim) + 10000))))
        for s, t in zip(raw, aim)
    ]
    out, able = {}, []
    for i, words, found in split:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(found), weight, score, None]
        if len(words) >= 20:
            able.append((-score, i))
    for rank, (_, i) in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        out[i][3] = rank
    return out


def test_resampling_against_brute_force(spark):
    rng = random.Random(9)
    pool = ["The", "oF", "x1", "naïve", "ÉTÉ", "漢字", "a-b", "don't", "😀", "in\x7fto", "\x00", "été", "Zz_9"] + [f"w{k}" for k in range(300)]
    rows = [(k * 7, rng.choice([" ", "  ", "\n", ", "]).join(rng.choice(pool) for _ in range(rng.randint(0, 60))), "s") for k in range(400)]
    rows += [(10_001, None, "s"), (10_002, "", "s"), (10_003, "...", "s"), (10_004, "long Word " * 30_000, "s"), (10_005, "y" * 300_000, "s")]
    target = ["the of w1 w2 w3 naïve", "ÉTÉ 漢字 " * 20, None]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    got = resampling.resample(table(spark, rows), items).collect()
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == resampled_by_hand(rows, target)


def test_words_beyond_the_dictionary(spark, monkeypatch):
    scanner, plain = resampling.Scanner(limit=3), resampling.Scanner()
    texts = ["a b a c d", "e f g h i j k l", "", "b  b.B\tab ba bab"]
    import pyarrow as pa

    for text in texts:
        data = resampling.text_bytes(pa.array([text, "the next row", None, text]))
        one, two = scanner.words(*data), plain.words(*data)
        assert all((x == y).all() for x, y in zip(one, two))
        words = features(text)[0]
        assert two[0].tolist()[: len(words)] == [zlib.crc32(w.encode()) for w in words]
        assert two[2].tolist() == [len(words), 3, 0, len(words)]


def test_resampling_of_odd_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert resampling.resample(table(spark, []), items).count() == 0
    rows = [(None, "word " * 40, "s"), (4, "word " * 40, "s"), (4, "word " * 40, "s"), (6, "word " * 40, "s"), (8, "word " * 40, "s")]
    got = resampling.resample(table(spark, rows), items.limit(0), percent=75).collect()
    assert [r.score for r in got if r.doc_id is None] == [None]
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
