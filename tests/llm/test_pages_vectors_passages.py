"""HTML extraction, embedding groups and benchmark passages."""

import random
import time

import numpy as np
import pytest

from tillworks.llm import decontamination, html_text, queries, vectors

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>home</a></header><nav><ul><li><a href="/a">a</a></ul></nav>
<div id="page"><div class="post-body"><h2>Title &eacute; &amp;amp;</h2>
<p>First para with a <a href='x>y'>link</a> and
  more&nbsp;words.<p>Second<br>line &lt;b&gt;.<ul><li>one<li>two</ul>
<script>if (a<b) document.write("</p>")</script><form><input><label>x</label>Name</form>
<table><tr><td>c1<td>c2<tr><td>c3</table><!-- <p>no</p> --></div>
<div class="comments"><p>A reader's own long comment that is not part of the text at all.</p></div>
<aside>side</aside><div role="alert">cookies</div></div><footer>foot</footer></body></html>"""


def test_page():
    want = "Title é &amp;\nFirst para with a link and more words.\nSecond line <b>.\none\ntwo\nc1\nc2\nc3"
    assert html_text.main_text(PAGE) == want


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain &lt; text & more", "plain < text & more"),
        ("<p>a</p><p>b &nbsp; c</p>", "a\nb c"),
        ("<article><p>hi</article>", "hi"),
        ("<article><h1>T</h1><p><b>T x.<br><p>y</p></article><div class=ad>buy</div>", "T\nT x.\ny"),
        ("<nav>menu</nav><footer>end</footer>", ""),
        ("<div class='ad3'>buy now</div><div id='main-1'><p>text</p></div>", "text"),
        ("<article><p>a</p><section id=comments><p>nice one, reader</p></section></article>", "a"),
        ("<article><header><h1>T</h1></header><p>a</p><div class='notice'>n</div></article>", "T\na"),
        ("<div>a < b and <3</div>", "a < b and <3"),
        ("<div title=\"x>y\">q</div>", "q"),
        ("<script>x", ""),
    ],
)
def test_small_pages(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize(
    "page", ["<div>" * 30_000 + "x", "<a " * 50_000, '<a href="x' * 20_000, "<p>x</p>" * 30_000, "<!--" * 20_000]
)
def test_pages_of_one_kind_take_no_square_time(page):
    began = time.time()
    html_text.main_text(page)
    assert time.time() - began < 20


def test_pages_table(spark, sf_dir):
    schema = "page_id bigint, url string, html string, text int"
    rows = [(1, "u", PAGE, 1), (None, None, None, 2), (1, "u", PAGE, 3)]
    got = html_text.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert [r.page_id for r in got].count(1) == 2 and {r.text for r in got if r.page_id is None} == {""}
    assert html_text.extract_text(spark.createDataFrame([], schema)).count() == 0
    for r in queries.op9(spark, sf_dir).collect():
        assert r.n_chars == len(r.text) > 0 and "track(" not in r.text and "  " not in r.text


def groups_by_hand(rows, least):
    ids, units = [], []
    for i, v in rows:
        usable = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ids.append(i)
        units.append(np.array(v) / np.abs(v).max() if usable else None)
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    parent, links = list(range(len(ids))), [0] * len(ids)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, u in enumerate(units):
        for j, v in enumerate(units[:i]):
            if u is not None and v is not None and len(u) == len(v) and u @ v >= least:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    name = {}
    for i, own in enumerate(ids):
        name[find(i)] = min(name.get(find(i), own), own)
    return sorted((own, links[i], name[find(i)], own == name[find(i)]) for i, own in enumerate(ids))


@pytest.mark.parametrize("cell_rows", [4096, 12])
def test_vector_groups(spark, cell_rows):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(12, 5))
    found = [list(map(float, base[rng.integers(12)] + rng.normal(size=5) * 0.3)) for _ in range(250)]
    found += [found[0]] * 30 + [[2 * x for x in found[1]], [1e200] * 5, [2e200] * 5, [1e-200] * 5]
    found += [None, [], [0.0] * 5, [float("nan")] * 5, [1.0, None], [float("inf"), 1.0], [1.0, 2.0], [2.0, 4.0]]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(found)), found)]
    table = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, vector string, rep int"
    ).repartition(4)
    got = vectors.near_groups(table, 0.9, cell_rows=cell_rows).collect()
    assert sorted(tuple(r) for r in got) == groups_by_hand(rows, 0.9)


def test_vector_rows_without_ids(spark):
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [0.0, 1.0]), (4, None), (4, None)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((tuple(r) for r in vectors.near_groups(table).collect()), key=str)
    assert got == sorted(
        [(None, 1, 3, False), (3, 1, 3, True), (None, 0, None, False), (4, 0, 4, True), (4, 0, 4, True)], key=str
    )
    assert vectors.near_groups(table.where("vec_id > 9")).count() == 0


def test_vector_table(spark, sf_dir):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op10(spark, sf_dir).collect()) == groups_by_hand(rows, 0.9)


def least_edits(item, text):
    """Fewest edits that turn the item into some stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passages(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(10, 25)))) for k in range(12)]
    items += [(50, "short one"), (51, None), (None, items[0][1]), (52, items[3][1].upper())]
    docs, texts = [], {}
    for i in range(60):
        body = [word() for _ in range(rng.randint(0, 40))]
        if i % 2:
            passage = list(items[rng.randrange(12)][1])
            for _ in range(rng.choice([0, 1, 4, 8, 14, 30])):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], ["x"], [passage[at], "y"]])
            body.insert(rng.randint(0, len(body)), "  \n".join("".join(passage).split(" ")))
        texts[i] = " ".join(body)
        docs.append((i, texts[i], "a", 1))
    docs += [(100, None, "a", 1), (101, "", "a", 1), (None, items[2][1], "a", 1), (103, items[2][1] * 2, "a", 1)]
    texts[103] = items[2][1] * 2
    schema = "doc_id bigint, text string, item_id string, start int"
    table = spark.createDataFrame(docs, schema).repartition(3)
    listed = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_passages(table, listed, rate=0.1).collect()
    got = {}
    for r in found:
        if r.doc_id is not None:
            assert r.passage == texts[r.doc_id][r.start : r.end]
            key = (r.doc_id, r.item_id)
            got[key] = min(got.get(key, 99), r.edits)
    want = {}
    for i, text in texts.items():
        for k, item in items:
            if k is not None and item and len(item) >= 40:
                edits = least_edits(item.lower(), " ".join(text.lower().split()))
                if edits <= min(int(0.1 * len(item)), (len(item) - 8) // 8):
                    want[(i, k)] = edits
    assert got == want and len(want) > 15 and any(want.values())
    assert any(r.doc_id is None for r in found)
    sliced = decontamination.find_passages(table, listed, rate=0.1, slice_chars=200).collect()
    assert sorted(map(str, sliced)) == sorted(map(str, found))
    assert decontamination.find_passages(table.where("doc_id < 0"), listed).count() == 0
    assert decontamination.find_passages(table, listed.where("item_id < 0")).count() == 0


def test_benchmark_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    same = lambda t: " ".join((t or "").lower().split())
    want = {(d.doc_id, i.item_id) for d in docs for i in items if same(i.text) in same(d.text)}
    got = {(r.doc_id, r.item_id) for r in queries.op2(spark, sf_dir).collect()}
    assert want and want <= got
