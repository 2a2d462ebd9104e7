"""The n-gram model against plain dictionaries, its lists and levels, and odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF
from tests.llm.conftest import TEXTS, rows_of
from tripmill.llm import language_model as lm
from tripmill.llm.queries import QUERIES

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def code(p):
    return min(max(int(np.rint(-math.log10(p) * lm.STEPS)), 0), lm.UNSEEN - 1)


def value(c):
    return 10.0 ** (-c / lm.STEPS)


class Plain:
    """The same model from dictionaries of whole n-grams, quantised at the same places."""

    def __init__(self, texts, order):
        self.order = order
        train = [self.tokens(t) for i, t in texts if self.trains(i)]
        self.counts = [Counter() for _ in range(order + 1)]
        self.contexts = [Counter() for _ in range(order + 1)]
        for tokens in train:
            for k in range(1, order + 1):
                for gram in self.grams(tokens, k):
                    self.counts[k][gram] += 1
                    self.contexts[k][gram[:-1]] += 1
        self.successors = [Counter(g[:-1] for g in counts) for counts in self.counts]
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])

    @staticmethod
    def trains(doc_id):
        return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1

    @staticmethod
    def tokens(text):
        return [*_WORD.findall((text or "").translate(_LOWER)), "</s>"]

    @staticmethod
    def grams(tokens, k):
        padded = ["<s>"] * (k - 1) + tokens
        return [tuple(padded[i : i + k]) for i in range(len(tokens))]

    def base(self, token):
        return (self.counts[1][(token,)] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def chance(self, gram):
        """log10, in the codes' steps wherever the model stores it."""
        k = len(gram)
        if k == 1:
            return math.log10(self.base(gram[0]))
        lower = self.chance(gram[1:])
        seen = self.contexts[k][gram[:-1]]
        if not seen:
            return lower
        t = lm.LEFT.get(k, lm.LEFT_BEYOND) * self.successors[k][gram[:-1]]
        if self.counts[k][gram]:
            return -code(min((self.counts[k][gram] + t * value(code(10**lower))) / (seen + t), 1.0)) / lm.STEPS
        return lower - code(t / (seen + t)) / lm.STEPS

    def score(self, text):
        return sum(self.chance(g) for g in self.grams(self.tokens(text), self.order))


def same(got, texts, order):
    plain = Plain(texts, order)
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], round(r["base_score"], 6), round(r["score"], 4), r["n_known"], r["train"]) for r in got))
    want = []
    for i, t in texts:
        tokens = plain.tokens(t)
        known = sum(plain.counts[1][(w,)] > 0 for w in tokens)
        base = sum(math.log10(plain.base(w)) for w in tokens)
        want.append((i is None, i or 0, len(tokens), round(base, 6), round(plain.score(t), 4), known, plain.trains(i)))
    assert [r[:3] + r[5:] for r in rows] == [r[:3] + r[5:] for r in sorted(want)]
    assert np.allclose([r[3:5] for r in rows], [r[3:5] for r in sorted(want)], atol=2e-3)
    assert {r["train_tokens"] for r in got} == {plain.n}


def test_query_equals_dictionaries_and_beats_the_base(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    got = rows_of(QUERIES["op12_lm_scoring"](spark, SF))
    same([r | {"train": not r["held_out"]} for r in got], texts, lm.ORDER)
    for fold in (True, False):
        better = [r["score"] > r["base_score"] for r in got if r["held_out"] == fold]
        assert sum(better) > len(better) / 2


@pytest.mark.parametrize("order", [2, 4])
def test_blocks_and_shards_change_nothing(spark, order):
    rng = np.random.default_rng(order)
    texts = [(k, " ".join(rng.choice(["the", "a", "b", "C", "d\te", "f\n", "é"], int(rng.integers(0, 30)), p=[0.4, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1]))) for k in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    whole = rows_of(lm.score_documents(docs, order=order, block=150, shard=300))
    same(whole, texts, order)
    # Split contexts estimate what they leave from a part of their successors: near, not equal.
    split = {r["doc_id"]: r for r in rows_of(lm.score_documents(docs, order=order, block=150, shard=300, hot=20))}
    apart = [abs(split[r["doc_id"]]["score"] - r["score"]) / r["n_tokens"] for r in whole]
    assert 0 < np.mean(apart) < 0.1 and {k: r["base_score"] for k, r in split.items()} == {r["doc_id"]: r["base_score"] for r in whole}


def test_odd_rows(spark, odd_documents, no_documents):
    same(rows_of(lm.score_documents(odd_documents)), TEXTS, lm.ORDER)
    assert rows_of(lm.score_documents(no_documents)) == []
    only = odd_documents.where("doc_id IN (5, 8)")
    from pyspark.sql import functions as F

    got = rows_of(lm.score_documents(only, train=F.lit(False)))
    assert {(r["base_score"], r["score"], r["n_known"], r["train_tokens"]) for r in got} == {(0.0, 0.0, 0, 0)}


@pytest.mark.parametrize("top", [1, 50, 10**6, 10**13])
def test_lists(top):
    rng = np.random.default_rng(7)
    values = np.unique(rng.integers(0, top, 3000))
    raw = np.frombuffer(lm.EliasFano.encode(values), np.uint8)
    held = lm.EliasFano(raw, 0)
    assert held.end == len(raw) and (held.access(np.arange(len(values))) == values).all()
    sought = np.r_[rng.integers(0, top + 5, 3000), values]
    assert (held.successor(sought) == np.searchsorted(values, sought)).all()
    at = np.searchsorted(values, sought)
    found = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == sought)
    assert (held.find(sought) == np.where(found, at, -1)).all()
    # The paper's bound: low bits and two a value, plus the header.
    assert len(raw) * 8 <= len(values) * (2 + max(0, math.ceil(math.log2(max(1, top / len(values)))))) + 32 * 8 + 2 * 64 * (held.low + 1) + len(values)
    none = lm.EliasFano(np.frombuffer(lm.EliasFano.encode(values[:0]), np.uint8), 0)
    assert none.n == 0 and (none.find(sought) == -1).all()


def test_level_searches_relative_to_the_context(tmp_path):
    rng = np.random.default_rng(3)
    grams = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 400, 5000), rng.integers(0, 60, 5000))})
    node, place = (np.array(c) for c in zip(*grams))
    codes = rng.integers(0, 255, len(grams)).astype(np.uint8)
    uri = f"file://{tmp_path}/level"
    contexts = np.unique(node)
    lm.put(uri, lm.Level.encode(node, place, codes, codes[: len(contexts)]))
    level = lm.Level(lm.mapped(uri))
    at, of, start = level.search(node, place)
    assert (at == np.arange(len(grams))).all() and (level.chances[at] == codes).all() and (contexts[of] == node).all()
    assert (level.weights[of] == codes[of]).all() and (start == np.searchsorted(node, node)).all()
    asked = [(a, b) for a in range(-0, 410) for b in range(0, 70, 7)]
    at, of, _ = level.search(*(np.array(c) for c in zip(*asked)))
    assert (level.codes(level.weights, of, 7)[of < 0] == 7).all()
    known = {g: k for k, g in enumerate(grams)}
    assert at.tolist() == [known.get(g, -1) for g in asked]


def test_bytes_round_trip():
    arrays = [np.array([0, 1, 255]), np.array([], int), np.array([1 << 40, 5]), np.zeros(4, int)]
    back = lm.unsqueeze(lm.squeeze(*arrays))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, back))
    some = np.array([5, 3, 3, 900, -1])
    assert (lm._from_steps(lm._steps(some)) == some).all()
    assert lm.unsqueeze(lm.squeeze()) == [] and len(lm.unsqueeze(lm.squeeze(arrays[1]))[0]) == 0


def test_words_of_many_texts_at_once():
    texts = [None, "a b", "b", "", " \t", "É x\vy\x00z\x1cw ", "Ab\n\r\faB", "日本 \u00a0é\u2003q", "end", None]
    raw = [None if t is None else t.encode() for t in texts]
    for kind in (pa.binary(), pa.large_binary()):
        for start, stop in ((0, len(raw)), (2, 7), (4, 4), (3, 5), (9, 10)):
            counts, sizes, text = lm.words(pa.array(raw, kind)[start:stop])
            want = [_WORD.findall((t or "").translate(_LOWER)) for t in texts[start:stop]]
            flat = [w.encode() for own in want for w in own]
            assert counts.tolist() == [len(own) for own in want] and sizes.tolist() == [len(w) for w in flat] and text == b"".join(flat)
            at, known = lm.numbered(sizes, text)
            assert known == list(dict.fromkeys(flat)) and [known[k] for k in at] == flat


def test_many_searches_decode_a_list_once(monkeypatch):
    rng = np.random.default_rng(11)
    values = np.unique(rng.integers(0, 10**8, 5000) ** 2)  # uneven buckets
    held = lm.EliasFano(np.frombuffer(lm.EliasFano.encode(values), np.uint8), 0)
    sought = np.r_[values, rng.integers(0, 10**16, 5000)]
    few = held.successor(sought[::200][: len(values) // lm.BULK - 1])
    assert (few == np.searchsorted(values, sought[::200])).all()
    calls, lows = [], lm.EliasFano.lows
    monkeypatch.setattr(lm.EliasFano, "lows", lambda self, i: calls.append(len(i)) or lows(self, i))
    assert (held.successor(sought) == np.searchsorted(values, sought)).all()
    assert calls == [len(values)]


def test_blocks_end_where_they_did(tmp_path, spark, monkeypatch):
    """Cut at the document that fills a block, however rows come; n-grams equal plain ones, also where keys need two numbers."""
    texts = [" ".join(f"w{k % 7}" for k in range(n)) for n in (3, 0, 50, 4, 1, 9, 120, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    plan = lm.Plan(f"file://{tmp_path}", 3, 1, 0, 0, lm.HOT)
    from pyspark.sql import functions as F

    cut = rows_of(lm._cut(plan, 20, F.col("doc_id") != 2, docs).orderBy("block"))
    assert [(r["tokens"], r["trained"], r["documents"]) for r in cut] == [(56, 5, 2), (138, 138, 4), (3, 3, 1)]
    block, plain = lm.Block(plan.block(1)), lm._sorted
    grams = list(block.grams(3))
    keys = lambda k: (lambda by: (k[by], by))(np.argsort(k, kind="stable"))
    monkeypatch.setattr(lm, "_sorted", keys)
    for one, other in zip(grams, block.grams(3)):
        assert all((a == b).all() for a, b in zip(one, other))
    big = np.array([1 << 61, 5, -1, 5, 1 << 60])
    assert (plain(big)[0] == np.sort(big)).all() and (big[plain(big)[1]] == np.sort(big)).all()
    high, low = np.array([1 << 40, 3, 3, 1 << 40, 3]), np.array([1 << 30, 2, 1, 1 << 30, 2])
    for shift in (0, 20):
        by, first = lm._runs(high << shift, low)
        assert (high[by] == [3, 3, 3, 1 << 40, 1 << 40]).all() and (low[by][:3] == [1, 2, 2]).all() and first.tolist() == [0, 1, 3]
