"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import __spark_entry__
import corpus_pipeline
from oracle import compare, database
from test_near_copies import groups_by_hand
from tillworks.llm import decontamination, packing, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf_dir, key):
    assert compare(queries.QUERIES[key](spark, sf_dir), database(sf_dir), queries.ORACLES[key]) == []


def test_all_are_registered():
    names = {k.split("_")[0] for k in __spark_entry__.queries() if k.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_stages(spark, sf_dir, stages):
    for docs in stages[:5]:
        assert docs.columns == COLUMNS
    ids = [{r.doc_id for r in docs.select("doc_id").collect()} for docs in stages]
    raw, spoken, cut, single, clean, packed = ids
    assert spoken == raw  # every document of this table is in one of its languages
    assert cut <= spoken and single <= cut and clean <= single and packed == clean
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    assert single == set(groups_by_hand(texts).values())
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_passages(stages[3], items, window=corpus_pipeline.ITEM_WINDOW)
    leaked = {r.doc_id for r in found.collect()}
    assert leaked and clean == single - leaked
    assert stages[2].where("n_chars <> length(text)").count() == 0
    pieces = packing.pack(stages[4], queries.tokenizer("word_bpe_49k.json"))
    assert pieces.agg({"length": "sum"}).first()[0] == stages[5].agg({"length": "sum"}).first()[0]


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == stages[5].columns and got.count() == stages[5].count()


def test_stages_with_odd_rows(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, carried int, n_lines int"
    rows = [
        (1, "the and of the other words in this line", "en", "a", 39, 1, 2),
        (1, "the and of the other words in this line", "en", "a", 39, 1, 2),
        (2, None, None, None, None, 1, 2),
        (3, "", "en", "b", 0, 1, 2),
        (4, "12 !!", "en", "b", 5, 1, 2),
        (None, "the words of no id", None, "c", 18, 1, 2),
        (5, "le la de les des " * 5000, "fr", "c", 80000, 1, 2),
    ]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            kept = stage(spark, kept, sf_dir)
        final = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
        got = sorted({r.doc_id for r in final.collect()}, key=str)
        assert got == ([1, 5, None] if docs.count() else [])
