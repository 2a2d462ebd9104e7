"""Benchmark items of fewer words than a shingle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tripmill.llm import decontamination


def test_short_items_are_found_as_whole_runs(spark):
    docs = spark.createDataFrame(
        [(1, "Two  words"), (2, "not two\nWORDS here"), (3, "two other words"), (4, "one"), (5, "a b c d e f"), (6, None), (7, "b c d")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "two words"), (2, "ONE"), (3, "b c d e"), (4, "a b c d e"), (5, " "), (6, None)], "item_id long, text string")
    got = decontamination.searched(docs, items, "inner").select("row.doc_id", F.explode("matches").alias("m"))
    found = sorted((r["doc_id"], r["m"]["item_id"], r["m"]["n_item"], r["m"]["n_shared"]) for r in rows_of(got))
    assert found == [(1, 1, 1, 1), (2, 1, 1, 1), (4, 2, 1, 1), (5, 3, 1, 1), (5, 4, 1, 1)]
    assert sorted(r["doc_id"] for r in rows_of(decontamination.decontaminate(docs, items))) == [3, 6, 7]
