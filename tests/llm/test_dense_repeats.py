"""Texts that repeat a stretch of benchmark items over and over."""

import pyarrow as pa

from tillworks.llm import decontamination

ITEMS = ["-" * 60, "-" * 60, "Question one: " + "-" * 40 + " and then the words go on for a while, see below."]


def passages(texts):
    index = decontamination.build_index(range(len(ITEMS)), ITEMS, 8, 0.1, 40, 48)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    return [tuple(r.values()) for found in decontamination._search([batch], index) for r in found.to_pylist()]


def test_blocks_do_not_change_what_is_found(monkeypatch):
    texts = ["-" * 700, "a " * 300, "", None, "before " + ITEMS[2] + " behind", "-" * 59 + "x" + "-" * 59]
    whole = passages(texts)
    monkeypatch.setattr(decontamination, "_BLOCK", 500)
    monkeypatch.setattr(decontamination, "_CELLS", 5000)
    monkeypatch.setattr(decontamination, "_ALIGNED", 16)
    assert sorted(passages(texts)) == sorted(whole)
    assert {doc for doc, *_ in whole} == {0, 4, 5}
    for doc, item, start, end, edits, passage in whole:
        assert passage == texts[doc][start:end] and edits <= 6
    assert {(0, 0), (0, 1)} <= {(doc, item) for doc, item, *_, edits, _ in whole if edits == 0}
    exact = [r for r in whole if r[0] == 4 and r[1] == 2]
    assert exact[0][2:5] == (7, 7 + len(ITEMS[2]), 0)
