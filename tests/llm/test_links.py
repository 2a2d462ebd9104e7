"""The links of the similarity join against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from tests.llm.conftest import rows_of
from tripmill.llm import jaccard_join


@pytest.mark.parametrize("block", [2_000_000, 900])
def test_all_links_between_distinct_sets(spark, monkeypatch, block):
    random.seed(10)
    base = [[f"w{g}_{i}" for i in range(100)] for g in range(3)]
    texts = [" ".join(b[random.randrange(8) : 100 - random.randrange(8)]) for b in base for _ in range(14)]
    rows = [*enumerate(texts), (100, texts[0]), (101, ""), (102, None), (103, "nothing like it at all")]
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    members, pairs = jaccard_join.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    digest = {r["doc_id"]: r["digest"] for r in rows_of(members)}
    assert len(digest) == len(rows) and digest[0] == digest[100] and digest[101] is None
    sets = {d: set(jaccard_join.token_set(t).tolist()) for (i, t) in rows if (d := digest[i]) is not None}
    expected = {}
    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 90 * len(sets[a] | sets[b]):
            expected[a, b] = shared
    got = rows_of(pairs)
    assert len(got) == len(expected) > len(sets)
    assert {(bytes(r["a"]), bytes(r["b"])): r["n_shared"] for r in got} == expected


def test_tokens_are_sent_with_all_their_bits():
    keys = np.array([1, 1 << 40 | 1, 1 << 63 | 1, 2**64 - 1], np.uint64)
    assert jaccard_join._unplaned(jaccard_join._planes(keys).tobytes()).tolist() == keys.tolist()
