"""Jaccard similarity join on word n-grams, filtered under several global token orders.

Two documents link when the Jaccard likeness of their sets of word n-grams reaches the threshold. With
o the least overlap, the n - o + 1 first tokens of a set under any global order hold a token of each
partner (prefix filter). Orders put rare tokens first and break ties by a hash of their own.

1. Every document becomes a set, and equal sets one class.
2. Tokens are dealt by hash; a task per range counts in how many sets each occurs, and sends back
   only those that occur twice or more. A set whose prefix is all unique tokens has no partner.
3. Sets that share a prefix token under the first order form clusters, by linear star edges.
4. Inside a cluster, pairs that also share prefix tokens under the other orders are verified exactly. A set
   is not compared with members of a component that it already belongs to, so a large group of
   copies costs one comparison each, and no pairs are emitted: only a spanning forest. Clusters over
   ``BLOCK_TOKENS`` tokens are cut into blocks, and every pair of blocks is a task.
5. Links form components.

``similar_pairs`` gives the join itself: every verified link between distinct sets, from the same clusters and
blocks. Its rows grow with the square of a group of different sets; copies add none.

Words are runs of bytes other than space and U+0009 to U+000D, A-Z lower-cased. Sets and tokens are compared
by 128 and 64-bit hashes.

Defined cases: a text of fewer words than an n-gram is one token of all its words; a text without
words, or null, has no token and links with nothing; rows that share a doc_id are documents of their own and
share a component only if they link; a null doc_id is never the smallest of a component with others; an empty table
gives an empty result; other columns are ignored; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, written
from tripmill.llm.components import components

#: Production parameters: words of an n-gram, least likeness in hundredths, token orders.
NGRAM, PERCENT, ORDERS = 3, 90, 3
#: Tokens that a task holds of a shard, of a hash range and of a block.
SHARD_TOKENS, RANGE_TOKENS, BLOCK_TOKENS = 1_000_000, 2_000_000, 2_000_000
_FACTOR = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_set(text: str | None, ngram: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the n-grams."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(ngram, len(found))
    if not n:
        return hashes
    total = np.full(len(found) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total += hashes[k : len(found) - n + 1 + k] * np.array(pow(_FACTOR, k + 1, 1 << 64), np.uint64)
    return np.unique(_mix(total))


def overlap(n, percent: int):
    """Least tokens that a set of n shares with any partner."""
    return -(-n * percent // 100)


def links(n_a: int, n_b: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (n_a + n_b - shared)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("text_hash"),
    )


def classes(docs: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """doc_id, text_hash, n_shingles and digest of the set (null for an empty one)."""

    def run(batches):
        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            sets = [token_set(t, ngram) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary")


_SENT = "part int, shard long, keys binary, owners binary, counts binary, digests binary, sizes binary"


def _sent(part, shard, keys=None, owners=None, counts=None, digests=None, sizes=None) -> dict:
    raw = lambda a: None if a is None else a.tobytes()
    return {
        "part": part, "shard": shard, "keys": raw(keys), "owners": raw(owners), "counts": raw(counts),
        "digests": digests, "sizes": raw(sizes),
    }


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], k) for c, k in zip(rows[0], kinds)], names=list(rows[0])
    )


def _planes(keys: np.ndarray) -> np.ndarray:
    """Keys as byte planes, the highest first: what is sorted compresses."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, ::-1].T)


def _unplaned(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes[::-1].T).view("<u8").reshape(-1)


def _shards(docs: DataFrame, parts: int, ngram: int) -> DataFrame:
    """Tokens by hash range: per shard and range the sorted keys and the places of their documents."""

    def run(batches):
        held: dict[bytes, np.ndarray] = {}
        size, task, done = 0, TaskContext.get().partitionId(), 0

        def flush():
            # The same number if the task runs again: what others have read stays valid.
            shard = task << 32 | done
            digests, sets = list(held), list(held.values())
            lengths = np.array([len(s) for s in sets])
            keys = np.concatenate(sets)
            owners = np.repeat(np.arange(len(sets), dtype=np.uint16), lengths)
            order = np.argsort(keys)
            keys, owners = keys[order], owners[order]
            # A range is a run of the sorted keys.
            of = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            ends = np.searchsorted(of, np.arange(parts + 1))
            out = [
                _sent(p, shard, _planes(keys[a:b]), owners[a:b])
                for p, (a, b) in enumerate(zip(ends, ends[1:])) if a < b
            ]
            out.append(_sent(shard % parts, shard, digests=b"".join(digests), sizes=lengths.astype("<u4")))
            for k in range(0, len(out), 64):
                yield _rows(out[k : k + 64])
            held.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = token_set(text, ngram)
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                if not len(tokens) or digest in held:
                    continue
                held[digest] = tokens
                size += len(tokens)
                if size >= SHARD_TOKENS or len(held) == 65_000:
                    yield from flush()
                    size, done = 0, done + 1
        if held:
            yield from flush()

    return _texts(docs).select("text").mapInArrow(run, _SENT)


def _repeated(table: pa.Table) -> pa.Table:
    """One hash range: the tokens that occur twice or more, back to their shards."""
    rows = table.to_pylist()
    out = [_sent(r["part"], r["shard"]) | {"digests": r["digests"], "sizes": r["sizes"]} for r in rows if r["digests"]]
    rows = [r for r in rows if r["keys"]]
    if rows:
        parts = [_unplaned(r["keys"]) for r in rows]
        keys = np.concatenate(parts)
        order = np.argsort(keys)
        ordered = keys[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.empty(len(keys), np.uint32)
        counts[order] = np.repeat(np.diff(np.r_[starts, len(keys)]), np.diff(np.r_[starts, len(keys)]))
        at = 0
        for r, part in zip(rows, parts):
            own = counts[at : at + len(part)]
            at += len(part)
            again = own > 1
            if again.any():
                rare = np.minimum(255, np.ceil(8 * np.log2(own[again]))).astype(np.uint8)
                owners = np.frombuffer(r["owners"], np.uint16)[again]
                out.append(_sent(r["part"], r["shard"], _planes(part[again]), owners, rare))
    if not out:
        out = [_sent(0, -1)]
    return pa.Table.from_batches([_rows(out)])


def _possible(percent: int):
    """One shard: sets whose prefix has a repeated token, with their repeated tokens."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        index = next((r for r in rows if r["digests"]), None)
        digests, sizes, tokens, counts = [], [], [], []
        found = [r for r in rows if r["keys"]]
        if index is not None and found:
            n = np.frombuffer(index["sizes"], "<u4").astype(np.int64)
            keys = np.concatenate([_unplaned(r["keys"]) for r in found])
            owners = np.concatenate([np.frombuffer(r["owners"], np.uint16) for r in found])
            rare = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in found])
            order = np.argsort(owners, kind="stable")
            keys, owners, rare = keys[order], owners[order], rare[order]
            ends = np.searchsorted(owners, np.arange(len(n) + 1))
            for k in np.flatnonzero(np.diff(ends) >= overlap(n, percent)):
                some = slice(ends[k], ends[k + 1])
                digests.append(index["digests"][16 * k : 16 * k + 16])
                sizes.append(int(n[k]))
                tokens.append(keys[some].tobytes())
                counts.append(rare[some].tobytes())
        return pa.table(
            [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary()), pa.array(counts, pa.binary())],
            names=["digest", "n", "tokens", "counts"],
        )

    return run


def prefix(n: int, tokens: np.ndarray, counts: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The repeated tokens among the first n - o + 1 under an order: unique tokens come before them."""
    take = n - overlap(n, percent) + 1 - (n - len(tokens))
    seed = np.array((order + 1) * _FACTOR % 2**64, dtype=np.uint64)
    return tokens[np.lexsort((_mix(tokens + seed), counts))[:take]]


def possible_sets(docs: DataFrame, n_tokens: int, ngram: int, percent: int) -> DataFrame:
    """digest, n, tokens, counts of the sets that may have a partner, each once."""
    parts = max(1, ceil(n_tokens / RANGE_TOKENS))
    sent = _shards(docs, parts, ngram).repartition(parts, "part").groupBy("part").applyInArrow(_repeated, _SENT)
    found = sent.groupBy("shard").applyInArrow(_possible(percent), "digest binary, n long, tokens binary, counts binary")
    return written(found, "possible").dropDuplicates(["digest"])


def clusters(sets: DataFrame, percent: int) -> DataFrame:
    """node (digest) and label of sets that share prefix tokens under the first order, directly or not."""

    def run(batches):
        for batch in batches:
            tokens, owners = [], []
            for digest, n, raw, rare in zip(*(c.to_pylist() for c in batch.columns)):
                first = prefix(n, np.frombuffer(raw, np.uint64), np.frombuffer(rare, np.uint8), 0, percent)
                tokens.append(first.view(np.int64))
                owners += [digest] * len(first)
            if owners:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens)), pa.array(owners, pa.binary())], names=["token", "a"]
                )

    rows = written(sets.mapInArrow(run, "token long, a binary"), "prefixes")
    hubs = rows.groupBy("token").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1")
    return components(rows.join(hubs.select("token", "b"), "token").select("a", "b"))


def forest(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """A star for each component of (n, tokens, counts) sets: places of a member and of the component's root.

    Stars, not the links that were found: chains of those would take the components many rounds.
    """
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    whole = [frozenset(r[1].tolist()) for r in rows]
    first = [[frozenset(prefix(*r, k, percent).tolist()) for k in range(ORDERS)] for r in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index: dict[int, dict[int, list[int]]] = {}
    for x in order:
        n, tried = rows[x][0], set()
        for token in first[x][0]:
            for group, members in list(index.get(token, {}).items()):
                if find(group) == find(x):
                    continue
                for y in reversed(members):  # the largest first; all are smaller than x
                    if rows[y][0] * 100 < percent * n:
                        break
                    if y in tried:
                        continue
                    tried.add(y)
                    # The other orders' prefixes must meet as well.
                    if any(first[x][k].isdisjoint(first[y][k]) for k in range(1, ORDERS)):
                        continue
                    if links(n, rows[y][0], len(whole[x] & whole[y]), percent):
                        root[find(x)] = find(y)
                        break
        mine = find(x)
        for token in first[x][0]:
            groups = index.setdefault(token, {})
            same = [g for g in groups if find(g) == mine]
            members = [m for g in same for m in groups.pop(g)] if len(same) > 1 else groups.pop(same[0]) if same else []
            if len(same) > 1:
                members.sort(key=lambda i: rows[i][0])
            members.append(x)
            groups[mine] = members
    return [(i, find(i)) for i in range(len(rows)) if find(i) != i]


def all_links(rows: list[tuple], own: list[int], percent: int) -> Iterator[tuple[int, int, int]]:
    """Places and shared tokens of every linked pair of (n, tokens, counts) sets, each once.

    If the sets are of two blocks, only pairs across them: those inside are found in the block's own task.
    """
    across = len(set(own)) > 1
    whole = [frozenset(r[1].tolist()) for r in rows]
    first = [[frozenset(prefix(*r, k, percent).tolist()) for k in range(ORDERS)] for r in rows]
    index: dict[int, list[int]] = {}
    for x in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        n, tried = rows[x][0], set()
        for token in first[x][0]:
            for y in reversed(index.get(token, ())):  # the largest first; all are smaller than x
                if rows[y][0] * 100 < percent * n:
                    break
                if y in tried or across and own[x] == own[y]:
                    continue
                tried.add(y)
                if any(first[x][k].isdisjoint(first[y][k]) for k in range(1, ORDERS)):
                    continue
                shared = len(whole[x] & whole[y])
                if links(n, rows[y][0], shared, percent):
                    yield x, y, shared
            index.setdefault(token, []).append(x)


def _blocks(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """label, i, j and own block of every set of a cluster, once for each pair of blocks."""
    placed = sets.join(labels.withColumnRenamed("node", "digest"), "digest")
    sizes = placed.groupBy("label").agg(F.sum("n").alias("total"), F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("total") / BLOCK_TOKENS).cast("int")
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")),
    )
    return (
        placed.join(sizes.select("label", blocks.alias("blocks")), "label")
        .withColumn("own", own)
        .withColumn("pair", F.explode(pairs))
        .select("label", "pair.i", "pair.j", "own", "digest", "n", "tokens", "counts")
    )


def linked(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b) digests: a spanning forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        got = table.to_pydict()
        rows = [
            (n, np.frombuffer(t, np.uint64), np.frombuffer(c, np.uint8))
            for n, t, c in zip(got["n"], got["tokens"], got["counts"])
        ]
        edges = forest(rows, percent)
        digests = got["digest"]
        return pa.table(
            [pa.array([digests[x] for x, _ in edges], pa.binary()), pa.array([digests[y] for _, y in edges], pa.binary())],
            names=["a", "b"],
        )

    return _blocks(sets, labels).drop("own").groupBy("label", "i", "j").applyInArrow(run, "a binary, b binary")


def similar_pairs(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links: :func:`classes`, and (a, b, n_shared) with a < b for every link between two digests of them.

    Documents of one digest are linked as well.
    """
    has_columns(docs, "doc_id", "text")
    known = written(classes(docs, ngram), "classes")
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    sets = written(possible_sets(docs, total, ngram, percent), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches).to_pydict()
        digests = got["digest"]
        rows = [
            (n, np.frombuffer(t, np.uint64), np.frombuffer(c, np.uint8))
            for n, t, c in zip(got["n"], got["tokens"], got["counts"])
        ]
        found = all_links(rows, got["own"], percent)
        while some := list(islice(found, 10_000)):
            pairs = [(*sorted((digests[x], digests[y])), shared) for x, y, shared in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*pairs), (pa.binary(), pa.binary(), pa.int64()))], names=["a", "b", "n_shared"]
            )

    blocks = _blocks(sets, clusters(sets, percent))
    return known, blocks.groupBy("label", "i", "j").applyInArrow(run, "a binary, b binary, n_shared long")


def similar_groups(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles and group of every document; the group of an empty set is null."""
    has_columns(docs, "doc_id", "text")
    known = written(classes(docs, ngram), "classes")
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    sets = possible_sets(docs, total, ngram, percent)
    joined = components(linked(sets, clusters(sets, percent), percent))
    return known.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("label", "digest").alias("group")
    )


def one_per_group(docs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """``docs`` without all rows of a group but one: that of the smallest doc_id, text hash and hash of its columns.

    Documents without words stay.
    """
    rows = written(similar_groups(docs, ngram, percent).where("group IS NOT NULL"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    kept = rows.groupBy("group").agg(first, F.count("*").alias("n")).where("n > 1")
    gone = (
        rows.join(kept, "group")
        .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))))
        .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    )
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("row_hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("row_hash") == F.col("gone_hash"))
    left = keyed.join(gone, same, "left_anti")
    # Rows that repeat doc_id and text of the one that stays.
    again = rows.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    again = written(again.select(F.col("doc_id").alias("again_id"), F.col("text_hash").alias("again_hash")), "again")
    if again.isEmpty():
        return left.select("row.*")
    same = F.col("row.doc_id").eqNullSafe(F.col("again_id")) & (F.col("row_hash") == F.col("again_hash"))
    # A task sends on one row of a key.
    one = (
        left.join(again, same, "left_semi")
        .groupBy(F.col("row.doc_id").alias("i"), "row_hash")
        .agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    )
    return left.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))


def op9_jaccard_join(spark, sf_dir):
    """Every document with its component of links at Jaccard 0.9 on three-word shingles."""
    rows = similar_groups(read(spark, sf_dir, "documents"))
    rows = written(rows.select("doc_id", "n_shingles", "group"), "groups")
    smallest = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    return rows.join(smallest.select("group", "least"), "group", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 90 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY ALL
"""
