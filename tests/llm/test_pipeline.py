"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

from itertools import combinations

import corpus_pipeline as pipeline
from tests.conftest import SF
from tests.llm.conftest import LINE, TEXTS, WORDS
from tripmill.llm import toxicity
from tripmill.llm.common import written
from tripmill.llm.line_dedup import WHITE

KEYS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str, size: int) -> set:
    words = text.translate(KEYS).encode().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_stages_keep_what_brute_force_keeps(spark):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    of = toxicity.Scorer(toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    expected = {r["doc_id"]: r["text"] for r in docs.collect() if of(r["text"] or "") < 0.5}

    def stage(k, rows):
        found = pipeline.STAGES[k][1](spark, rows, SF)
        assert found.columns == columns
        return found

    rows = stage(0, docs)
    assert {r["doc_id"]: r["text"] for r in rows.collect()} == expected

    holders: dict[str, set] = {}
    key = lambda line: line.strip(WHITE).translate(KEYS)
    for i, text in expected.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    expected = {
        i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in expected.items()
    }
    rows = stage(1, rows)
    got = rows.collect()
    assert {r["doc_id"]: r["text"] for r in got} == expected and all(r["n_chars"] == len(r["text"]) for r in got)

    sets = {i: shingles(t, 5) for i, t in expected.items()}
    root = {i: i for i in expected}
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in combinations(sorted(expected), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    expected = {i: t for i, t in expected.items() if find(i) == i}
    rows = stage(2, rows)
    assert {r["doc_id"] for r in rows.collect()} == set(expected)

    items = [shingles(r["text"] or "", 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in expected if not any(10 * len(s & sets[i]) >= 8 * len(s) for s in items if s)}
    rows = stage(3, rows)
    assert {r["doc_id"] for r in rows.collect()} == clean

    packed = pipeline.STAGES[4][1](spark, rows, SF).collect()
    assert {r["doc_id"] for r in packed} == clean
    assert {r["doc_id"] for r in pipeline.run(spark, SF).collect()} == clean


def test_odd_and_empty_rows(spark, odd_documents, no_documents, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns go through every stage."""
    sf_dir = str(tmp_path)
    odd_documents.write.parquet(f"{sf_dir}/documents.parquet")
    for table, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{sf_dir}/{table}.parquet")
    rows, columns = spark.read.parquet(f"{sf_dir}/documents.parquet"), odd_documents.columns
    seen = []
    for _, stage in pipeline.STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), "stage")
        assert rows.columns == columns
        found = rows.collect()
        assert {r["line"] for r in found} == {"extra line"} and {r["shard"] for r in found} == {"extra shard"}
        seen.append(sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in found)))
    whole = sorted((i is None, i or 0, t or "") for i, t in TEXTS)
    assert seen[0] == whole and len(seen[1]) == len(TEXTS)
    # A line of five documents stays in the last of them, 12, which has it on both of its rows.
    assert [t for _, i, t in seen[1] if i in (8, 10, 11)] == ["own eight", "", ""] and (False, 12, f"{LINE}\n\nlast") in seen[1]
    left = [i for _, i, _ in seen[2]]
    assert 5 in left and not {6, 7} & set(left) and left.count(12) == 1 and {1, 2, 3, 10, 11} <= set(left)
    assert seen[3] == seen[2] and any(t == WORDS for _, _, t in seen[2])
    packed = pipeline.STAGES[-1][1](spark, rows, sf_dir).collect()
    assert {(r["doc_id"]) for r in packed} == {None if none else i for none, i, _ in seen[3]}
    assert sorted((r["sequence_id"], r["offset"]) for r in packed) == sorted({(r["sequence_id"], r["offset"]) for r in packed})
    for _, stage in pipeline.STAGES:
        assert stage(spark, no_documents, sf_dir).count() == 0
