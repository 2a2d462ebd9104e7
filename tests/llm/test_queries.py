"""Registered queries against their SQL, or against brute force where SQL has no words for them."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from check_oracle import compare, oracle_connection
from tests.conftest import SF
from tripmill.llm import sharding
from tripmill.llm.queries import ORACLE_SQL, QUERIES
from tripmill.llm.tokens import encoder, vocabulary_path


@pytest.fixture(scope="module")
def texts():
    found = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    return dict(found)


@pytest.fixture(scope="module")
def ids(texts):
    """By one plain call of the tokenizer for each text."""
    tokenizer = encoder(vocabulary_path()).tokenizer
    found = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    return {i: e.ids for i, e in zip(texts, found)}


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) >= 11


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    difference, _ = compare(spark, oracle_connection(SF), name, SF)
    assert difference is None


def test_fingerprints(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    keys = list(texts)
    assert sorted(got) == keys
    marks = {}
    for k, i in enumerate(keys):
        text, following = texts[i], texts[keys[(k + 1) % len(keys)]]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert marks.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    above = [r.near_edited > r.near_next for r in got.values()]
    assert sum(above) > 0.9 * len(above)


def test_packing(spark, ids):
    pieces = QUERIES["op2_best_fit_packing"](spark, SF).toPandas()
    assert sorted(set(pieces.doc_id)) == sorted(ids)
    for doc_id, group in pieces.sort_values(["doc_id", "piece"]).groupby("doc_id"):
        whole, start = [*ids[doc_id], 0], 0
        for k, r in enumerate(group.itertuples()):
            assert (r.piece, r.start, r.ids_crc32) == (k, start, crc(whole[start : start + r.length]))
            assert r.length == 2048 or (k == 0 and r.length <= 2048)
            start += r.length
        assert start == len(whole)
    used = []
    for _, group in pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert group.offset.tolist() == [0, *np.cumsum(group.length)[:-1]]
        used.append(group.length.sum())
    assert max(used) <= 2048 and len(used) <= 1.02 * np.ceil(sum(used) / 2048) + 1


def test_token_files(spark, ids):
    start = 0
    got = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, SF).collect()}
    assert len(got) == len(ids)
    for doc_id, own in ids.items():
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own) + 1, crc([*own, 2]))
        start += len(own) + 1


def test_toxicity(spark):
    got = QUERIES["op5_toxicity"](spark, SF).toPandas()
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_suffix_dedup(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op7_suffix_dedup"](spark, SF).collect()}
    seen: set[bytes] = set()
    for doc_id, text in texts.items():
        raw = text.encode()
        own = [raw[k : k + 50] for k in range(len(raw) - 49)]
        gone = np.zeros(len(raw), bool)
        for k, string in enumerate(own):
            if string in seen:
                gone[k : k + 50] = True
        seen.update(own)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        r = got[doc_id]
        expected = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected


def test_sharding(spark, texts):
    got = QUERIES["op10_sharding"](spark, SF).toPandas()
    assert sorted(got.doc_id) == list(texts)
    for r in got.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, sharding.SHARDS)
    for _, group in got.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))


def test_shards_by_plain_draws(spark, texts):
    """Region, rack and shard by weighted exponential draws, hashed in plain Python."""
    import math

    import xxhash

    def draw(level, path, weights, key):
        def score(child):
            seed = xxhash.xxh64_intdigest(level.encode(), 42)
            for step in (*path, child):
                seed = xxhash.xxh64_intdigest(int(step).to_bytes(4, "little"), seed)
            bits = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed) >> 11
            return -math.log((bits + 0.5) / 2**53) / weights[child], child

        return min(map(score, range(len(weights))))[1]

    def leaf(tree, key):
        by_region, by_rack, by_shard = tree.weights()
        region = draw("region", [], by_region, key)
        rack = draw("rack", [region], by_rack[region], key)
        return tree.leaves[region][rack][draw("shard", [region, rack], by_shard[region][rack], key)][0]

    tree = sharding.planned_tree()
    got = QUERIES["op10_sharding"](spark, SF).collect()
    assert {r.doc_id: (r.shard, r.grown_shard) for r in got} == {
        i: (leaf(tree, i), leaf(tree.grown(sharding.SHARDS), i)) for i in texts
    }


def test_scores_are_the_logits_of_the_fitted_weights(spark, texts):
    """A text's logit is the sum of the weights of its distinct words, whatever its other columns say."""
    import math
    import re

    import xxhash

    from tripmill.llm import toxicity

    weights = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: (r.score, r.predicted) for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    for doc_id, text in texts.items():
        found = sorted({xxhash.xxh3_64_intdigest(w) for w in re.findall(r"\w+", text.lower())})
        logit = math.fsum([weights.get(0, -math.inf), *(weights.get(h, 0.0) for h in found)])
        want = 1 / (1 + math.exp(-logit)) if logit > -700 else 0.0
        assert abs(got[doc_id][0] - want) < 1e-9 and got[doc_id][1] == int(want >= 0.5)


def test_fingerprints_by_plain_sets(spark, texts):
    """A document's terms, its share of rare ones, and the subsets that its likeness compares, from plain sets."""
    import math

    from tripmill.llm import fingerprints as fp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    distinct = {t for t in texts.values()}
    df: dict[int, int] = {}
    for text in distinct:
        for h in {fp.term_hash(t) for t in fp.terms(text)}:
            df[h] = df.get(h, 0) + 1
    low, high = (len(distinct) / math.exp(i) for i in reversed(fp.IDF_BAND))
    band, above = fp.lexicon(docs)
    assert set(band.tolist()) == {h for h, n in df.items() if low <= n <= high}
    assert set(above.tolist()) == {h for h, n in df.items() if n > high}
    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}

    def chosen(text):
        """Terms in the band; if they are fewer than the share, the rarest others up to it."""
        all_ = {fp.term_hash(t) for t in fp.terms(text)}
        inside = {h for h in all_ if low <= df.get(h, 0) <= high}
        missing = math.ceil(fp.SHARE * len(fp.terms(text))) - len(inside)
        if missing <= 0:
            return inside, 0
        rare = sorted(h for h in all_ if df.get(h, 0) < low)[:missing]
        common = sorted((h for h in all_ if df.get(h, 0) > high), key=lambda h: (df[h], h))[: missing - len(rare)]
        return inside | set(rare) | set(common), missing

    filled = 0
    for doc_id, text in texts.items():
        some, missing = chosen(text)
        filled += missing > 0
        hashes = np.array(sorted(some), dtype=np.uint64)
        assert got[doc_id].fingerprint == fp._fingerprint(hashes, fp.depths(hashes)).text()
    assert filled < len(texts)
