"""Parts of benchmark items and short items in documents."""

import random

import corpus_pipeline
from tillworks.llm import decontamination, queries


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def found(spark, docs, items):
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    listed = spark.createDataFrame(items, "item_id bigint, text string")
    return decontamination.find_passages(table, listed, rate=0.1, window=48).collect()


def test_parts_of_items(spark):
    rng = random.Random(8)
    items = [(k, " ".join(words(rng, 60))) for k in range(8)]
    docs, quoted = [], {}
    for i in range(40):
        body, item = words(rng, 50), items[i % 8][1]
        size = rng.randint(64, len(item) // 2)
        at = rng.randint(0, len(item) - size)
        quote = item[at : at + size]
        if i % 4 == 3 and size > 130:  # edited, but less than a tenth
            quote = quote[:20] + "x" + quote[21:70] + quote[72:]
        if i % 5:
            body.insert(rng.randint(0, 50), "| " + quote.upper() + " |")
            quoted[i] = (i % 8, quote)
        docs.append((i, " ".join(body)))
    got = found(spark, docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == {(i, k) for i, (k, _) in quoted.items()}
    texts = dict(docs)
    for r in got:
        assert r.passage == texts[r.doc_id][r.start : r.end]
    longest = {}
    for r in got:
        longest[r.doc_id] = max(longest.get(r.doc_id, ""), r.passage, key=len)
    for i, (k, quote) in quoted.items():
        assert len(longest[i]) >= len(quote.strip()) - 22
        if quote in items[k][1]:
            assert longest[i].lower().startswith(quote.strip()) or quote.strip() in longest[i].lower()
            assert [r.edits <= 8 for r in got if r.doc_id == i] == [True]  # at the edges only


def test_whole_items_are_reported_once(spark):
    rng = random.Random(9)
    item = " ".join(words(rng, 40))
    got = found(spark, [(1, " ".join(words(rng, 20) + [item] + words(rng, 20)))], [(4, item)])
    assert [(r.doc_id, r.item_id, r.edits, r.passage) for r in got] == [(1, 4, 0, item)]


def test_short_items(spark):
    items = [(1, "What is 2+2?"), (2, "the capital"), (3, "Zoë"), (4, ""), (5, "  "), (6, "日本"), (7, "what is 2+2?")]
    docs = [
        (1, "He asked: what  IS\n2+2? Nobody knew"),
        (2, "the capitals of other bathe capital"),
        (3, "zoë"),
        (4, "zoës, azoë"),
        (5, "これは日本語"),
        (6, None),
        (7, ""),
    ]
    got = {(r.doc_id, r.item_id, r.passage, r.edits) for r in found(spark, docs, items)}
    assert got == {
        (1, 1, "what  IS\n2+2?", 0), (1, 7, "what  IS\n2+2?", 0), (3, 3, "zoë", 0), (5, 6, "日本", 0)
    }


def test_query_and_stage_find_parts(spark, tmp_path):
    rng = random.Random(10)
    item, body = " ".join(words(rng, 50)), words(rng, 40)
    rows = [(1, " ".join(body + [item[:150]])), (2, " ".join(body)), (None, item[:150])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op2(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 7), (None, 7)}
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {2, None}
