"""Ranked search: its bounds lose nothing, ties and odd rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from tests.llm.conftest import TEXTS, rows_of
from tripmill.llm import ranked_search

_PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return _PATTERN.findall((text or "").translate(_LOWER))


def brute(texts: list[tuple], items: dict, top: int = 50) -> dict:
    """item -> [(doc_id, score)], from whole texts and plain loops."""
    held = [(i, Counter(plain_terms(t))) for i, t in texts]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_all, n_words = len(held), sum(n for _, _, n in held)
    out = {}
    for item, text in items.items():
        scores = []
        weights = {}
        for term in set(plain_terms(text)):
            df = sum(term in c for _, c, _ in held)
            weights[term] = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))
        for doc_id, counts, n in held:
            m = 100 - 50 + (50 * n * n_all) // n_words
            score = sum(w * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m)) for t, w in weights.items())
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item] = [(d, -s) for s, _, _, d in sorted(scores)[:top]]
    return {i: f for i, f in out.items() if f}


def ranked(rows) -> dict:
    out: dict = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert len(out[r["item_id"]]) == r["rank"]
    return out


def test_terms_are_maximal_matches():
    text = "A-b_c\x00Ñandú 日本x9\x7f\x85\xa0Z`q{r}\r\n@K"
    assert [t.decode() for t in ranked_search.terms(text.encode())] == plain_terms(text)


def test_bounds_lose_nothing(spark, monkeypatch):
    # Few documents a bucket and slice, so that all bounds are at work; copies make ties at the cut.
    monkeypatch.setattr(ranked_search, "BUCKET", 16)
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(300)]
    share = 1 / np.arange(1, 301)
    draw = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    texts = [(k, draw(int(rng.integers(3, 80)))) for k in range(400)]
    texts += [(1000 + k, texts[7][1]) for k in range(70)]
    items = {k: draw(12) for k in range(9)} | {50: texts[7][1], 51: "nothing here", 52: None}
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = ranked_search.search_documents(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"), block=4)
    assert ranked(rows_of(found)) == brute(texts, items)
    # Length ends the walk, coordinates rule out more: fewer than a quarter of the documents are scored.
    vocabulary = {t: k for k, t in enumerate(sorted(set(items[50].split())))}
    vectors = []
    for doc_id, text in texts:
        counts = Counter(t for t in text.split() if t in vocabulary)
        vectors.append((doc_id, len(text.split()), np.array([vocabulary[t] for t in counts], int), np.array(list(counts.values()), int)))
    n, total = len(vectors), sum(v[1] for v in vectors)
    df = np.bincount(np.concatenate([v[2] for v in vectors]), minlength=len(vocabulary))
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for k in df])
    number = np.argsort(-weight, kind="stable")
    one = ranked_search.Items([50], [number], [weight[number]], n, total, [0])
    bounded, scored = ranked_search.search(vectors, one, ranked_search.Best(one))
    assert scored < bounded < n / 2 and scored < n / 4


def test_odd_rows(spark, odd_documents, no_documents):
    items = {1: "word3 WORD4, word5", 2: "a", 3: "", 4: None, 5: "日本 é", None: "no id one two"}
    rows = spark.createDataFrame([*items.items(), (2, "b x"), (1, "word3")], "item_id long, text string").selectExpr("*", "'extra' AS term", "1 AS rank")
    found = ranked(rows_of(ranked_search.search_documents(odd_documents, rows)))
    assert found == brute(TEXTS, items | {2: "a b x"})
    assert [d for d, _ in found[1]] == [5, 6, 7] and found[1][0][1] == found[1][1][1] >= found[1][2][1]
    assert [d for d, _ in found[None]] == [16, None]
    assert rows_of(ranked_search.search_documents(no_documents, rows)) == []
    assert rows_of(ranked_search.search_documents(odd_documents, rows.limit(0))) == []
