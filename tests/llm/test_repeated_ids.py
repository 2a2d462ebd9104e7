"""Rows that share a doc_id."""

from __future__ import annotations

import zlib

from tests.llm.conftest import rows_of
from tripmill.llm import jaccard_join, toxicity


def test_training_takes_one_text_for_each_labelled_id(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:20]
    rows = [(ids[0], f"text number {k}") for k in range(300)] + [(i, f"own words{i}") for i in ids[1:]] + [(ids[1], None)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda samples, c: seen.append([(y, own.tolist()) for y, own, _ in samples]) or {})
    for order in (rows, rows[::-1]):
        toxicity.train(spark.createDataFrame(order, "doc_id long, text string"), labels, most=10)
        toxicity.train(spark.createDataFrame(order, "doc_id long, text string"), labels)
    assert [len(s) for s in seen] == [10, 20, 10, 20] and seen[0] == seen[2] and seen[1] == seen[3]


def test_one_row_of_a_group_stays(spark):
    text = "a group of rows that hold the same words"
    rows = [(1, text, k) for k in range(20)] + [(2, text, 0), (3, "on its own, twice", 0), (3, "on its own, twice", 1), (3, "other words", 0)]
    rows += [(None, "no id, three times", 0)] * 3 + [(4, "", 0), (4, "", 0), (5, None, 0), (5, None, 0)]
    kept = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, extra long")
        kept.append(sorted((tuple(r.values()) for r in rows_of(jaccard_join.one_per_group(docs, 3, 90))), key=str))
    assert kept[0] == kept[1]
    found = sorted(((i, t) for i, t, _ in kept[0]), key=str)
    assert found == sorted(
        [(1, text), (3, "on its own, twice"), (3, "other words"), (None, "no id, three times"), (4, ""), (4, ""), (5, None), (5, None)], key=str
    )
