"""Nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LINE, TEXTS, rows_of
from tripmill.llm import (
    decontamination,
    fingerprints,
    jaccard_join,
    line_dedup,
    packing,
    sharding,
    suffix_dedup,
    token_files,
    toxicity,
)
from tripmill.llm.tokens import encoder, vocabulary_path


def test_fingerprints(odd_documents, no_documents):
    got = rows_of(fingerprints.fingerprint_documents(odd_documents))
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[5]["fingerprint"] == by_id[6]["fingerprint"]
    assert by_id[5]["near_next"] == 1.0 and by_id[1]["near_next"] == 1.0
    assert rows_of(fingerprints.fingerprint_documents(no_documents)) == []


def test_packing(odd_documents, no_documents):
    got = rows_of(packing.pack_documents(odd_documents, vocabulary_path()))
    assert {r["doc_id"] for r in got} == {i for i, _ in TEXTS}
    assert sum(r["doc_id"] == 12 for r in got) == 2 and len(set((r["sequence_id"], r["offset"]) for r in got)) == len(got)
    assert max(r["piece"] for r in got) > 2  # the long text
    assert rows_of(packing.pack_documents(no_documents, vocabulary_path())) == []


def test_lines(odd_documents, no_documents):
    got = rows_of(line_dedup.dedup_lines(odd_documents, batches=3))
    kept = {r["row"]["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got}
    assert len(got) == len(TEXTS) and got[0]["row"]["line"] == "extra line"
    assert kept[1] == kept[2] == ("", 1, 0)
    assert kept[8] == ("own eight", 2, 1) and kept[9] == ("own nine", 2, 1)
    assert kept[10] == ("", 2, 2) and kept[11] == ("", 1, 1)
    assert kept[12] == (f"{LINE}\n\nlast", 3, 0)
    assert rows_of(line_dedup.dedup_lines(no_documents)) == []


def test_decontamination(spark, odd_documents, no_documents):
    items = spark.createDataFrame(
        [(1, "word3 word4 word5 word6 word7 word8 word9 word10"), (2, "too short"), (None, None), (3, ""),
         (4, "WORD20 word21 word22 word23 word24 word25 word26 word27 word28 other")],
        "item_id long, text string",
    )
    got = decontamination.searched(odd_documents, items, "inner").select("row.doc_id", F.explode("matches").alias("m"))
    assert {(r["doc_id"], r["m"]["item_id"]) for r in rows_of(got)} == {(d, i) for d in (5, 6, 7) for i in (1, 4)}
    clean = decontamination.decontaminate(odd_documents, items)
    assert clean.columns == odd_documents.columns and clean.count() == len(TEXTS) - 3
    assert decontamination.decontaminate(odd_documents, items.limit(0)).count() == len(TEXTS)
    assert decontamination.decontaminate(no_documents, items).count() == 0


def test_jaccard(odd_documents, no_documents):
    got = rows_of(jaccard_join.similar_groups(odd_documents))
    groups = {r["doc_id"]: (r["n_shingles"], r["group"]) for r in got}
    assert len(got) == len(TEXTS)
    assert groups[1] == groups[2] == groups[3] == (0, None)
    assert groups[4][0] == 1 and groups[5] == groups[6] and groups[5][1] == groups[7][1]
    kept = jaccard_join.one_per_group(odd_documents, 3, 90)
    assert kept.columns == odd_documents.columns
    assert {5, 6, 7} & {r["doc_id"] for r in rows_of(kept)} == {5}
    assert rows_of(jaccard_join.similar_groups(no_documents)) == []


def test_suffixes(odd_documents, no_documents):
    got = {r["doc_id"]: r for r in rows_of(suffix_dedup.remove_repeats(odd_documents))}
    assert got[6]["kept"] == b"" and got[7]["n_removed"] == len(TEXTS[4][1]) and got[1]["n_bytes"] == 0
    assert got[14]["n_removed"] == 0 and got[15]["n_removed"] == 0  # repeats inside a document stay
    assert None in got and got[13]["n_removed"] == 0
    assert rows_of(suffix_dedup.remove_repeats(no_documents)) == []


def test_token_files(odd_documents, no_documents, tmp_path):
    files = token_files.write_token_files(odd_documents, str(tmp_path / "a"), vocabulary_path(), file_ids=3000)
    got = sorted(rows_of(token_files.read_token_files(files)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, *sorted(i for i, _ in TEXTS if i)]
    one = token_files.TokenFile(files.orderBy("part").first()["file"])
    tokenizer = encoder(vocabulary_path()).tokenizer
    assert one.document(0).tolist() == [*tokenizer.encode(TEXTS[14][1], add_special_tokens=False).ids, 2]
    assert rows_of(token_files.read_token_files(token_files.write_token_files(no_documents, str(tmp_path / "b"), vocabulary_path()))) == []


def test_documents_over_several_blocks(spark, tmp_path):
    """Documents and ranges of ids that reach over blocks of 65,536 ids, with repeated ids and texts."""
    import numpy as np

    words = "alpha beta, gamma\n\ndelta  epsilon"
    texts = [(1, words * 20_000), (2, "short"), (2, words * 9_000), (3, None), (2, "short"), (4, words * 30_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    files = token_files.write_token_files(docs, str(tmp_path / "a"), vocabulary_path(), file_ids=10**7)
    one = token_files.TokenFile(files.first()["file"])
    tokenizer = encoder(vocabulary_path()).tokenizer
    plain = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in texts}
    held = [ids.tolist() for _, ids in one.documents()]
    assert one.doc_ids.tolist() == [1, 2, 2, 2, 3, 4] and sorted(map(len, held)) == sorted(len(plain[t]) for _, t in texts)
    assert held[0] == plain[texts[0][1]] and held[4] == [2] and held[5] == plain[texts[5][1]] == one.document(5).tolist()
    assert sorted(held[1:4]) == sorted(plain[t] for i, t in texts if i == 2)
    assert one.n_ids > 4 * token_files.BLOCK
    whole = np.concatenate([np.array(h) for h in held])
    for start, stop in ((0, one.n_ids), (65_530, 65_540), (65_536, 131_072), (100_000, 300_001), (7, 7)):
        assert (one.ids(start, stop) == whole[start:stop]).all()


def test_sharding(odd_documents, no_documents):
    tree = sharding.planned_tree()
    got = rows_of(sharding.shard_documents(odd_documents, tree))
    assert len(got) == len(TEXTS) and all(0 <= r["shard"] < 24 for r in got)
    assert next(r for r in got if r["doc_id"] == 1)["size"] == 8
    assert rows_of(sharding.shard_documents(no_documents, tree)) == []


def test_toxicity(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(odd_documents, none) == {}
    got = rows_of(toxicity.score_documents(odd_documents, {}))
    assert len(got) == len(TEXTS) and {r["score"] for r in got} == {0.0}
    labels = spark.createDataFrame([(None, 0, 1), (5, 0, None), (7, 1, 3), (1, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = rows_of(toxicity.score_documents(odd_documents, toxicity.train(odd_documents, labels)))
    assert all(0 <= r["score"] <= 1 for r in got) and got[0]["row"]["score"] == "extra score"
    assert rows_of(toxicity.score_documents(no_documents, {0: 1.0})) == []


def test_missing_columns(spark):
    with pytest.raises(ValueError):
        jaccard_join.similar_groups(spark.range(1))
