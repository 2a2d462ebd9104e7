"""What each method promises, on small inputs."""

from __future__ import annotations

import random
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tripmill.llm import fingerprints, jaccard_join, line_dedup, packing, sharding, suffix_dedup, toxicity, warc
from tripmill.llm import token_files as files
from tripmill.llm.components import components
from tripmill.llm.tokens import Encoder, vocabulary_path


def test_encoder_equals_plain_calls():
    one = Encoder(vocabulary_path())
    texts = [
        "", " ", "\n", "a", " a", "a ", "a  b", "a\n\n b. c,", "don't we'll, x.\ty", "a b   c", "x\x1c y",
        "<|endoftext|> a<|endoftext|>", "a.\nB c.\nD", "é ñ. 12,3 4.", "a\0b \0 c", "..., ,. a.,", "\r\n a\r\nb",
        "日本 語。", "a'.b '.", "x,\ny", "x ,y . z", "tab\tin word. next,",
    ]
    plain = [np.array(e.ids, "<u4").tobytes() for e in one.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert one.encode(texts) == plain and one.encode(texts) == plain and one.encode(texts[::-1]) == plain[::-1]


def test_special_literals_get_the_ids_of_an_untouched_tokenizer():
    from tokenizers import AddedToken, Tokenizer

    texts = [
        "a<|endoftext|>b", "a <|endoftext|> b", "a  <|endoftext|>  b", "<|endoftext|>", "\n<|endoftext|>\n", "a\n<|endoftext|>\nb",
        "<|endoftext|><|endoftext|>, x", "a\t<|endoftext|> ", "see <|end of|> it", "ends <|r|> here", "xword, b", "plain words",
    ]
    plain = Tokenizer.from_file(vocabulary_path())
    ids = lambda of: [np.array(of.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    one = Encoder(vocabulary_path())
    assert one.encode(texts) == ids(plain) and one.encode(texts) == ids(plain)
    plain.add_special_tokens(["<|end of|>", AddedToken("<|r|>", rstrip=True), "word,"])
    with tempfile.NamedTemporaryFile(suffix=".json") as file:
        plain.save(file.name)
        other = Encoder(file.name)
        assert other.encode(texts) == ids(plain) and other.encode(texts) == ids(plain)


@pytest.mark.parametrize("width", [1, 7, 16, 17, 31])
def test_bits_round_trip(width):
    ids = np.random.default_rng(1).integers(0, 1 << width, 1000).astype("<u4")
    raw = files.pack(ids, width)
    assert len(raw) == 16 * 8 * width and (files.unpack(raw, width, 1000) == ids).all()


def test_plan_covers_each_rank_once_and_never_overfills():
    random.seed(2)
    for capacity in (16, 100, 2048):
        counts = {n: random.randrange(1, 400) for n in random.sample(range(1, capacity + 1), min(12, capacity // 2))}
        bins: dict[int, list] = {}
        for length, low, high, first, each, base in packing.plan(counts, capacity):
            for rank in range(low, high):
                bins.setdefault(first + (rank - low) // each, []).append((base + (rank - low) % each * length, length))
        placed = [p for b in bins.values() for p in b]
        assert {n: sum(p[1] == n for p in placed) for n in counts} == counts
        for b in bins.values():
            end = 0
            for offset, length in sorted(b):
                assert offset == end
                end += length
            assert end <= capacity
            assert sum(3 * length > capacity for _, length in b) <= 2


def test_sequences_hold_their_pieces(odd_documents):
    placed = packing.pack_documents(odd_documents, vocabulary_path(), with_ids=True)
    for r in rows_of(packing.sequences(placed)):
        assert len(r["ids"]) == 4 * sum(r["lengths"]) <= 4 * packing.CAPACITY


def test_runs_meet_in_levels(spark):
    lines = spark.createDataFrame([(d, k, -k) for d in range(8) for k in range(d + 1)], "doc_id long, h1 long, h2 long")
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    for low, high in ((6, 8), (4, 6), (2, 4), (0, 2)):
        runs.add(lines.where(F.col("doc_id").between(low, high - 1)))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    got = {r["h1"]: (r["n_docs"], r["holder"]) for r in rows_of(runs.close("h1 long, h2 long, n_docs long, holder long, held boolean"))}
    assert got == {k: (8 - k, 7) for k in range(8)}


def test_a_line_of_all_documents_is_counted_before_its_exchange(spark):
    lines = spark.range(20_000).selectExpr("id % 1 AS h1", "id % 1 + 2 AS h2", "id AS doc_id")
    counted = line_dedup.LineRuns._counted(lines.repartition(8))
    plan = counted._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [x.split("(")[0].strip(" +-:*0123456789").split(" ")[0] for x in plan]
    steps = [x for x in steps if x in ("HashAggregate", "Exchange")]
    # Counted, exchanged by key, counted; below that distinct pairs, exchanged by key and document.
    assert steps[:5] == ["HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange"]
    assert [(r.n_docs, r.holder) for r in counted.collect()] == [(20_000, 19_999)]


def test_archives_push_down_and_read_without_an_index(spark, tmp_path):
    pages = spark.createDataFrame(
        [(3, "u", "aa"), (1, None, "aa"), (2, "v\nw", None), (None, "x", "bb"), (7, "x", "bb"), (7, "x", "bb"),
         (8, "y", "é" * 200_000), (9, "z", "")], "page_id long, url string, html string",
    ).withColumn("payload", F.lit("clash"))
    uri = str(tmp_path / "archive")
    warc.archive_pages(pages, uri)
    expected = sorted([(1, 2, "response", None), (2, 0, "response", None), (3, 2, "revisit", 1), (7, 2, "revisit", None),
                       (7, 2, "revisit", None), (8, 400_000, "response", None), (9, 0, "revisit", 2), (None, 2, "response", None)], key=str)

    def read():
        rows = rows_of(warc.read_archive(spark, uri))
        return sorted([(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows], key=str)

    assert read() == expected
    some = spark.read.format("warc").load(uri).where("record_type = 'revisit' AND refers_to = '<urn:page:1>'")
    assert [r["record_id"] for r in rows_of(some)] == ["<urn:page:3>"]
    reader = warc.WarcReader({"path": uri}, [])
    for index in (tmp_path / "archive").glob("*.idx"):
        index.rename(index.with_suffix(".off"))
    assert read() == expected and all(p.records is None for p in reader.partitions())
    headers = spark.read.format("warc").option("payload", "false").load(uri)
    assert headers.where("payload IS NOT NULL").count() == 0 and headers.count() == 8
    for n, empty in enumerate((pages.limit(0), spark.createDataFrame([], pages.schema))):
        warc.archive_pages(empty, str(tmp_path / f"none{n}"))
        assert rows_of(warc.read_archive(spark, str(tmp_path / f"none{n}"))) == []


def test_unwanted_payloads_are_not_inflated(spark, tmp_path, monkeypatch):
    """Records of unwanted types are not opened; of those that a header rules out only the first bytes are inflated."""
    text = "".join(chr(97 + k * k % 26) for k in range(300_000))
    pages = [(k, f"{text[: 100_000 + k // 2]}", "u") for k in range(8)]
    uri = str(tmp_path / "archive")
    warc.archive_pages(spark.createDataFrame(pages, "page_id long, html string, url string").coalesce(1), uri)
    inflated, opened, plain = [0], [0], zlib.decompressobj

    class Counting:
        def __init__(self, *args):
            self.plain = plain(*args)
            opened[0] += 1

        def decompress(self, *args):
            out = self.plain.decompress(*args)
            inflated[0] += len(out)
            return out

        def __getattr__(self, name):
            return getattr(self.plain, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)

    def read(payload, *filters):
        inflated[0] = opened[0] = 0
        reader = warc.WarcReader({"path": uri, "payload": payload}, [])
        assert list(reader.pushFilters(list(filters))) == []
        rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
        return rows, opened[0], inflated[0]

    rows, records, whole = read("true")
    assert (rows, records) == (8, 8) and whole > 4 * 100_000
    rows, records, some = read("true", warc.EqualTo(("record_type",), "revisit"))
    assert (rows, records) == (4, 4) and some < 4 * 4096
    rows, records, some = read("true", warc.EqualTo(("record_id",), "<urn:page:3>"))
    assert (rows, records) == (1, 8) and some < 100_000 + 9 * 4096
    rows, records, none = read("false")
    assert (rows, records) == (8, 8) and none <= 8 * 4096


def test_files_without_a_manifest_are_not_read(spark, tmp_path):
    uri = str(tmp_path / "archive")
    pages = spark.createDataFrame([(k, f"page {k}") for k in range(20)], "page_id long, html string").repartition(4)
    warc.archive_pages(pages, uri)
    # What a task left that was repeated or whose job failed, and an archive from elsewhere.
    left = next((tmp_path / "archive").glob("_*.warc.gz"))
    (tmp_path / "archive" / ("_" + "0" * 32 + ".warc.gz")).write_bytes(left.read_bytes())
    assert len(rows_of(warc.read_archive(spark, uri))) == 20
    (tmp_path / "archive" / "other.warc.gz").write_bytes(left.read_bytes())
    assert len(rows_of(warc.read_archive(spark, uri))) > 20

    writer = warc.WarcWriter({"path": uri}, [])
    lost = writer.write(iter([Row(record_type="response", payload=b"x")]))
    writer.abort([lost, None])
    assert not any(lost.files[0].endswith(p.name) for p in (tmp_path / "archive").iterdir())


def test_min_revisit_keeps_small_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "aaaa"), (4, "aaaa")], "page_id long, html string")
    warc.archive_pages(pages, str(tmp_path / "w"), min_revisit=3)
    got = {r["page_id"]: r["record_type"] for r in rows_of(warc.read_archive(spark, str(tmp_path / "w")))}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_counterfactuals_spare_neutral_mentions():
    random.seed(4)
    turn = toxicity.swaps()
    samples, neutral = [], []
    for k in range(1200):
        filler = {f"w{random.randrange(400)}" for _ in range(15)}
        toxic = k % 4 == 0
        # "muslim" is mentioned mostly in toxic texts; half of these say nothing else that tells.
        found = filler | ({"muslim"} if toxic or k % 40 == 1 else set()) | ({"scum"} if toxic and k % 8 else set())
        hit = found & turn.keys()
        other = toxicity.hashes((found - hit) | {turn[w] for w in hit}) if hit else None
        samples.append((int(toxic), toxicity.hashes(found), other))
        neutral.append(filler | {"muslim"})
    plain, fair = (toxicity.Scorer(toxicity.fit(samples, c)) for c in (0.0, 20.0))
    text = lambda s: " ".join(s)
    rate = [sum(of(text(s)) >= 0.5 for s in neutral) / len(neutral) for of in (plain, fair)]
    assert rate[1] < rate[0] and rate[1] < 0.1
    assert fair("scum") > 0.5


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels))
    rows = scored.select("row.doc_id", "score").join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    toxic = [r.score >= 0.5 for r in rows if r.toxic]
    clean = [r.score >= 0.5 for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02


def test_likeness_follows_what_is_shared():
    random.seed(3)
    words = [f"t{i}" for i in range(5000)]
    of = fingerprints.Fingerprinter(np.sort(np.array([fingerprints.term_hash(w) for w in words], np.uint64)))
    for n in (20, 300, 3000):
        own, other = random.sample(words, n), random.sample(words, n)
        a = of(" ".join(own))
        assert a == a and a.likeness(of(" ".join(reversed(own)))) == 1.0
        near, far = a.likeness(of(" ".join(own[: 3 * n // 4] + other[: n // 4]))), a.likeness(of(" ".join(other)))
        assert near > far and 0 <= far < near <= 1
    assert of("").likeness(of("")) == 1.0 and of("").likeness(of("t1")) == 0.0
    assert of("zzz qqq").likeness(of("zzz qqq")) == 1.0


def test_near_copies_on_a_third_of_the_rows_are_alike(spark):
    random.seed(9)
    common = " ".join(f"shared{i}" for i in range(120))
    other = lambda: " ".join(f"t{random.randrange(3000)}" for _ in range(120))
    # Plain copies, and near copies with a word that a few other texts hold too.
    group = {3 * k: f"{common} t{k}" if k % 2 else common for k in range(150)}
    docs = spark.createDataFrame([(k, group.get(k) or other()) for k in range(450)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows_of(fingerprints.fingerprint_documents(docs))}
    assert np.mean([got[k]["near_edited"] for k in group]) > 0.15

    def mark(k):
        raw = got[k]["fingerprint"]
        return fingerprints.Fingerprint(int(raw[:2], 16), np.frombuffer(bytes.fromhex(raw[2:]), ">u2").reshape(fingerprints.LEVELS, -1))

    assert min(mark(0).likeness(mark(k)) for k in group) > 0.7
    assert max(got[k]["near_next"] for k in group) < 0.1


def test_copies_count_once_in_the_lexicon(spark, monkeypatch):
    rows = [(k, "copied words") for k in range(50)] + [(k, f"own{k} mid{k % 20}") for k in range(50, 149)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for slots in (fingerprints.SLOTS, 64):
        monkeypatch.setattr(fingerprints, "SLOTS", slots)
        texts, n = fingerprints.once(docs)
        assert n == 101 and sorted(r["text"] for r in rows_of(texts)) == sorted({t or "" for _, t in rows})
    inside, above = fingerprints.lexicon(docs, (0.0, 3.5))
    assert set(inside.tolist()) == {fingerprints.term_hash(f"mid{k}") for k in range(20)} and not len(above)


def test_forest_spans_the_components():
    random.seed(6)
    base = [np.unique(np.array([random.getrandbits(60) for _ in range(80)], np.uint64)) for _ in range(12)]
    sets = []
    for b in base:
        for _ in range(8):
            changed = b.copy()
            changed[random.sample(range(len(b)), random.randrange(0, 8))] = [random.getrandbits(60)] and random.getrandbits(60)
            sets.append(np.unique(changed))
    everywhere, counts = np.unique(np.concatenate(sets), return_counts=True)
    df = dict(zip(everywhere.tolist(), counts.tolist()))
    rows = []
    for s in sets:
        again = np.array([t for t in s.tolist() if df[t] > 1], np.uint64)
        rows.append((len(s), again, np.array([min(255, df[t]) for t in again.tolist()], np.uint8)))
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a in range(len(sets)):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if jaccard_join.links(len(sets[a]), len(sets[b]), shared, 90):
                root[find(a)] = find(b)
    truth = [find(i) for i in range(len(sets))]
    root = list(range(len(sets)))
    for a, b in jaccard_join.forest(rows, 90):
        root[find(a)] = find(b)
    got = [find(i) for i in range(len(sets))]
    assert {(truth[a] == truth[b]) == (got[a] == got[b]) for a in range(len(sets)) for b in range(a)} == {True}


def test_blocks_of_a_large_cluster_lose_no_link(spark, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(words[:100] + [f"own{k}"])) for k in range(30)] + [(99, "something else entirely here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 700)
    got = rows_of(jaccard_join.similar_groups(docs))
    assert len({r["group"] for r in got if r["doc_id"] < 99}) == 1 and len({r["group"] for r in got}) == 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(f"p{i:02}", f"p{i + 1:02}") for i in range(20)] + [("s", f"t{i}") for i in range(20)] + [("q", "q")]
    got = {r["node"]: r["label"] for r in rows_of(components(spark.createDataFrame(edges, "a string, b string")))}
    assert {v for k, v in got.items() if k[0] == "p"} == {"p00"} and {v for k, v in got.items() if k[0] in "st"} == {"s"}
    assert rows_of(components(spark.createDataFrame([], "a string, b string"))) == []


def test_growth_moves_rows_only_into_the_new_shard(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = sharding.planned_tree()
    got = sharding.assign(sharding.assign(rows, tree), tree.grown(24), name="grown").toPandas()
    moved = got[got.shard != got.grown]
    assert set(moved.grown) == {24} and 0.5 < len(moved) / (20_000 / 25) < 1.5
    assert got.groupby("shard").size().min() > 0.8 * 20_000 / 24


@pytest.mark.parametrize("alphabet", [2, 3, 26])
def test_suffix_arrays(alphabet):
    random.seed(alphabet)
    for n in (1, 50, 60, 700):
        data = np.array([random.randrange(alphabet) for _ in range(n)], np.uint8)
        for some in (data, np.tile(data[: max(1, n // 7)], 7)):
            raw = some.tobytes()
            order = suffix_dedup.suffix_array(some)
            assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
            shared = suffix_dedup.common_prefixes(some, order)
            for k in range(1, len(raw)):
                a, b = raw[order[k - 1] :][:50], raw[order[k] :][:50]
                assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_runs_merge_by_binary_search():
    rng = np.random.default_rng(7)
    owner = rng.integers(0, 50, 4000)
    keys = rng.integers(0, 900, 4000).astype(np.uint64)
    runs = []
    for a in range(0, 4000, 500):
        order = a + np.lexsort((owner[a : a + 500], keys[a : a + 500]))
        fresh = np.r_[True, keys[order][1:] != keys[order][:-1]]
        runs.append((keys[order][fresh], order[fresh]))
    known, best = suffix_dedup.merge_runs(runs, owner)
    assert known.tolist() == sorted(set(keys.tolist()))
    assert all(owner[at] == owner[keys == key].min() for key, at in zip(known, best))


def test_shards_agree_with_one(spark, monkeypatch):
    random.seed(8)
    passage = "".join(random.choice("abcdefgh ") for _ in range(90))
    texts = [(k, f"{random.random()} {passage if k % 3 else passage[:55]} {random.random()}" * (1 + k % 2)) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    whole = sorted(rows_of(suffix_dedup.remove_repeats(docs)), key=lambda r: r["doc_id"])
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 500)
    assert sorted(rows_of(suffix_dedup.remove_repeats(docs)), key=lambda r: r["doc_id"]) == whole
    assert sum(r["n_removed"] for r in whole) > 1000 and zlib.crc32(whole[0]["kept"]) == zlib.crc32(texts[0][1].encode())


def test_anchors_spread_evenly_over_ranges():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    row = {"ids": np.array([1]).tobytes(), "ends": np.array([len(data)]).tobytes(), "data": data.tobytes()}
    first, end, anchor = suffix_dedup.Shard(row).strings()
    # Anchors are minima of many hashes: by their own value nearly all are in the first ranges.
    cut = suffix_dedup._ranges(np.sort(anchor), 20)
    assert np.diff(cut).max() < 1.2 * len(anchor) / 20 and np.diff(cut).min() > 0.8 * len(anchor) / 20
    # Found piece by piece, they are those of the whole.
    assert (np.repeat(anchor, end - first) == suffix_dedup._mix(suffix_dedup.anchors(data))).all()


def test_rows_of_many_shards_are_few_sorted_runs(monkeypatch):
    rng = np.random.default_rng(4)
    words = [rng.integers(97, 123, 60).astype(np.uint8) for _ in range(30)]
    rows, expected = [], {}
    owners = {k: [] for k in range(30)}
    for shard in range(300):
        held = rng.choice(30, 3, replace=False)
        docs = rng.integers(0, 1000, 3)
        for k, doc in zip(held.tolist(), docs.tolist()):
            owners[k].append(doc)
        starts = np.array([100, 300, 500])
        rows.append((0, shard, starts.tobytes(), (starts + 11).tobytes(), docs.tobytes(), np.concatenate([words[k] for k in held]).tobytes()))
        expected[shard] = list(zip(starts.tolist(), held.tolist(), docs.tolist()))
    seen, merge = [], suffix_dedup.merge_runs
    monkeypatch.setattr(suffix_dedup, "merge_runs", lambda runs, owner: seen.append(len(runs)) or merge(runs, owner))
    found = {s: (np.frombuffer(a, np.int64).tolist(), np.frombuffer(b, np.int64).tolist()) for _, s, a, b, _, _ in suffix_dedup._compared(suffix_dedup._found(rows))}
    assert seen == [1]
    for shard, strings in expected.items():
        gone = [start for start, k, doc in strings if doc > min(owners[k])]
        assert found.get(shard, ([], [])) == (gone, [start + 60 for start in gone])


def test_letters_with_marks_go_to_the_model_once():
    from tokenizers import Tokenizer

    one = Encoder(vocabulary_path())
    texts = [
        "alpha*** beta, gamma;\nalpha### beta gamma!!", "(x) don't 12; a_b éß%%% ñ.,. word'; a\n\"b\" \n", "alpha beta;, Gamma:\nbeta",
        "| a |", "日本。 語; x́, ²; ª! _ __ a_", "a<|endoftext|>;;; b", "\n|\n;a", "İ, ß?",
    ]
    plain = Tokenizer.from_file(vocabulary_path()).encode_batch(texts, add_special_tokens=False)
    expected = [np.array(e.ids, "<u4").tobytes() for e in plain]
    assert one.encode(texts) == expected and one.encode(texts[::-1]) == expected[::-1]

    one, by_model, whole = Encoder(vocabulary_path()), [], []
    tokenize, ids = one.tokenizer.model.tokenize, one._ids
    one.tokenize = lambda text: by_model.append(text) or tokenize(text)
    one._ids = lambda some: whole.extend(some) or ids(some)
    marked = [f"{w}{m}" for w in ("zeta", "omega") for m in ("", ",", ".", ";", "!!", "***", "$$$")]
    one.encode([" ".join(["The", *marked])])
    # A word is learned once however it ends, and marks once behind any word.
    assert sorted(by_model) == ["The", "Ġomega", "Ġzeta"] and sorted(whole) == ["!!", "$$$", "***", ",", ".", ";"]


def test_many_words_go_to_the_tokenizer_together():
    from tokenizers import Tokenizer

    one, calls = Encoder(vocabulary_path()), []
    tokenize, ids = one.tokenizer.model.tokenize, one._ids
    one.tokenize = lambda text: calls.append(text) or tokenize(text)
    one._ids = lambda some: calls.append(some) or ids(some)
    draw = np.random.default_rng(5)
    letters, marks = [*"abcdefghimnorstéñç日"], ["", "", "", ",", ".", ";!", "***"]
    words = ["".join(draw.choice(letters, n)) + draw.choice(marks) for n in draw.integers(1, 14, 6000)]
    words[::50] = ["it's", "12.5", "a1", "(x)", "a×", "é×", "語。", "", "tab\there", "\n", "x\xa0y", "<|endoftext|>,"] * 10
    texts = [("\n" if k % 3 else " ").join(words[k : k + 40]) for k in range(0, 6000, 40)] + ["", " ", "a", "a  b"]
    plain = Tokenizer.from_file(vocabulary_path()).encode_batch(texts, add_special_tokens=False)
    assert one.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain]
    # Not a call for each word; texts with unusual white space are encoded by themselves.
    assert len(calls) < len(texts)
    assert one.encode([]) == [] and one.encode(["a b", ""])[1] == b""


def test_texts_are_encoded_in_slices_of_bytes(monkeypatch):
    import pyarrow as pa

    texts = [None, "", "a b", "x " * 500 + "y", "é", None, "last one"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    whole = [ids for _, some in files.ids_of_texts(batch, vocabulary_path(), b"end.") for ids in some]
    assert whole == [raw + b"end." for raw in Encoder(vocabulary_path()).encode([t or "" for t in texts])]
    monkeypatch.setattr(files, "SLICE_BYTES", 4)
    found = [(some.column(0).to_pylist(), ids) for some, ids in files.ids_of_texts(batch, vocabulary_path(), b"end.")]
    assert [k for k, _ in found] == [[0, 1, 2], [3], [4, 5], [6]] and [raw for _, ids in found for raw in ids] == whole


def test_pieces_are_cut_where_they_are_encoded(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, None), (2, "x " * 5000)], "doc_id long, text string")
    rows = packing.token_pieces(docs, vocabulary_path())
    assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    found = sorted(tuple(r)[:5:2] + (r.length,) for r in rows.drop("copy").collect())
    assert len(found) == 5 and sum(n for *_, n in found) == sum(
        len(i) // 4 + 1 for i in Encoder(vocabulary_path()).encode(["one two", "", "x " * 5000])
    )
