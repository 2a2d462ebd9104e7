"""N-gram language model in Elias-Fano tries, built and queried shard by shard.

Documents are cut into blocks of about ``BLOCK`` tokens, kept as files with block-local word numbers. For each order a block
asks for its distinct n-grams, dealt over shards by context; a shard adds up the training counts of all blocks, writes its
level of the trie and answers from it, in the order asked. So no n-gram travels once per occurrence and no task holds the
model. The first order gives word ids (frequent words low) and counts; order k ≥ 2 asks with the trie node of the context and
the word's place among the successors of the shorter context (context-relative, so mostly a small number).

A level holds, for a shard: context nodes, pointers to their successors, and the successors made monotone by a running base,
all in Elias-Fano lists; for every n-gram its smoothed probability and for every context the weight it leaves to the
shorter one, each quantised to 8 bits of -log10. Files are memory-mapped; a query is a successor search in the context's range.

Smoothing is Witten-Bell interpolation, p(w | c) = (n(cw) + t·p(w | c')) / (n(c) + t), t being ``LEFT`` times the distinct
successors of c, down to p(w) = (n(w) + 0.5) / (N + 0.5·(V + 1)), which is also the base score. Contexts of more than ``HOT``
occurrences are split over shards by word; each part takes t from its own share of successors and occurrences.

A word's place is told by 64-bit hashes only to deal it out; words are compared whole. All counts, statistics and n-grams of
all training documents are kept: no cut-off. Files go below ``spark.checkpoint.dir`` by ``pyarrow.fs`` under names that a repeated
task writes again with the same content. Each block sends a row to every shard and order: with many blocks and shards these
rows shrink, at worst to one n-gram each; larger blocks and shards mend it.

Defined cases: a null or empty text is the end token alone; a null doc_id counts as an empty text in the fold's hash and so
trains; rows that share a doc_id are documents each; without training documents N and V are 0 and every token has
probability 1; an empty table gives an empty result; texts have no length limit; other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import has_columns, read, roomy, written
from tripmill.llm.token_files import pack
from tripmill.session import scratch_dir

#: Production parameters: order, tokens of a block and of a shard, occurrences from which a context is split.
ORDER, BLOCK, SHARD, HOT = 3, 1 << 21, 3 << 20, 1 << 20
#: Weight of the shorter context for each distinct successor, by order; words are sparser than what follows two of them.
LEFT = {2: 4.0}
LEFT_BEYOND = 1.0
FOLDS, HELD_OUT = 5, 1
#: Seconds between the attempts to free a pass's shuffle files.
RELEASE_SECONDS = 1.0
#: Searches for at least one in so many of a list's elements decode the list once.
BULK = 8
#: Codes per unit of -log10, and the code of what was not seen.
STEPS, UNSEEN = 16, 255
#: A-Z lower-cased, 0x09 to 0x0D a space.
_PLAIN = bytes(0x20 if 0x09 <= b <= 0x0D else b + 32 * (0x41 <= b <= 0x5A) for b in range(256))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of texts in UTF-8 (null: empty): words of each, bytes of each word, and the words without what parts them."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), b""
    bounds = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, 8 * texts.offset)
    raw = texts.buffers()[2]
    raw = raw[int(bounds[0]) : int(bounds[-1])].to_pybytes() if raw else b""
    bounds, plain = bounds - bounds[0], np.frombuffer(raw.translate(_PLAIN), np.uint8)
    inside = plain != 0x20
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # A word ends with its text.
    edges = bounds[bounds < len(plain)]
    first[edges] = inside[edges]
    edges = bounds[bounds > 0] - 1
    last[edges] = inside[edges]
    first = np.flatnonzero(first)
    return np.diff(np.searchsorted(first, bounds)), np.flatnonzero(last) - first + 1, plain[inside].tobytes()


def numbered(sizes: np.ndarray, text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Words, one after the other in ``text``, as numbers in the order of their first occurrence; and the distinct ones."""
    ends = np.r_[0, np.cumsum(sizes)].astype("<i8")
    held = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
    return held.indices.to_numpy(), held.dictionary.to_numpy(zero_copy_only=False).tolist()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, UNSEEN - 1).astype(np.uint8)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread numbers over 63 bits."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)).astype(np.int64)


# Bytes of arrays, and files of them.


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of integers ≥ 0 in the fewest byte planes, compressed."""
    head, planes = [len(arrays)], []
    for a in arrays:
        size = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
        head += [len(a), size]
        planes.append(a.astype(np.uint8).tobytes())
        planes += [(a >> 8 * k).astype(np.uint8).tobytes() for k in range(1, size)]
    body = b"".join(planes)
    packed = pa.Codec("zstd", compression_level=1).compress(body, asbytes=True)
    return np.array([*head, len(body)], "<u8").tobytes() + packed


def unsqueeze(raw: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(raw, "<u8", 1)[0])
    head = np.frombuffer(raw, "<u8", 2 * count + 2)[1:].astype(np.int64)
    body = pa.Codec("zstd").decompress(raw[8 * (2 * count + 2) :], int(head[-1]), asbytes=True)
    out, at = [], 0
    for n, size in zip(head[:-1:2].tolist(), head[1:-1:2].tolist()):
        a = np.frombuffer(body, np.uint8, n, at).astype(np.int64)
        for k in range(1, size):
            a |= np.frombuffer(body, np.uint8, n, at + k * n).astype(np.int64) << 8 * k
        out.append(a)
        at += n * size
    return out


def _signed(steps: np.ndarray) -> np.ndarray:
    """Differences as numbers ≥ 0, small ones small."""
    return steps << 1 ^ steps >> 63


def _steps(values: np.ndarray) -> np.ndarray:
    return _signed(np.diff(values, prepend=0))


def _from_steps(values: np.ndarray) -> np.ndarray:
    return np.cumsum(values >> 1 ^ -(values & 1))


def _paired(high: np.ndarray, low: np.ndarray) -> np.ndarray | None:
    """Numbers that rise as (high, low) does, where 63 bits hold them."""
    bits = int(low.max(initial=0)).bit_length()
    return high << bits | low if int(high.max(initial=0)).bit_length() + bits < 64 else None


def _order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ascending (high, low); rows that are equal in both come in any order."""
    key = _paired(high, low)
    return np.lexsort((low, high)) if key is None else _sorted(key)[1]


def _runs(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same order, and where each distinct pair starts in it."""
    key = _paired(high, low)
    if key is not None:
        key, by = _sorted(key)
        return by, np.flatnonzero(np.diff(key, prepend=-1))
    by = np.lexsort((low, high))
    return by, np.flatnonzero((np.diff(high[by], prepend=-1) != 0) | (np.diff(low[by], prepend=-1) != 0))


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys of at least -1, and where each was. One sort of 64-bit numbers where key and place fit into one."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits < 64:
        both = keys << bits
        both |= np.arange(len(keys))
        both.sort()
        return both >> bits, both & ((1 << bits) - 1)
    by = np.argsort(keys)
    return keys[by], by


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put(uri: str, raw: bytes) -> None:
    store, path = _store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        out.write(raw)
    store.move(draft, path)


def get(uri: str) -> bytes:
    store, path = _store(uri)
    with store.open_input_file(path) as file:
        return file.read()


def mapped(uri: str) -> np.ndarray:
    """A file's bytes, memory-mapped; of another store through an unnamed local copy."""
    store, path = _store(uri)
    if store.type_name == "local":
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as copy, store.open_input_stream(path) as file:
        while chunk := file.read(1 << 22):
            copy.write(chunk)
        copy.flush()
        return np.memmap(copy, np.uint8, "r")


# The trie.


class EliasFano:
    """A monotone list of integers ≥ 0: low bits packed, high bits in unary."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = np.zeros(n + (top >> low) + 1, np.uint8)
        bits[(values >> low) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").tobytes()
        lows = pack(values & ((1 << low) - 1), low) if low and n else b""
        high += bytes(-len(high) % 8)
        return np.array([n, low, len(lows), len(high)], "<i8").tobytes() + lows + high

    def __init__(self, raw: np.ndarray, at: int) -> None:
        self.n, self.low, lows, high = np.frombuffer(raw[at : at + 32], "<i8").tolist()
        self.words = raw[at + 32 : at + 32 + lows].view("<u8")
        self.high = raw[at + 32 + lows : at + 32 + lows + high]
        self.end = at + 32 + lows + high
        bits = np.unpackbits(self.high, bitorder="little").view(bool)
        self.highs = np.flatnonzero(bits) - np.arange(self.n)
        # Values below each bucket of equal high bits: the ones before the zero that ends the bucket before.
        buckets = (int(self.highs[-1]) if self.n else 0) + 1
        self.below = np.r_[0, np.flatnonzero(~bits[: self.n + buckets])[:buckets] - np.arange(buckets)]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        out = self.words[word] >> shift
        split = np.flatnonzero(shift + np.uint64(self.low) > 64)
        out[split] |= self.words[word[split] + 1] << (np.uint64(64) - shift[split])
        return out & np.uint64((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return (self.highs[i] << self.low) | self.lows(i).astype(np.int64)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first element of at least each value (n if there is none)."""
        if len(values) * BULK >= self.n:
            return np.searchsorted(self.access(np.arange(self.n)), values)
        high = np.minimum(values >> self.low, len(self.below) - 1)
        first = self.below[high]
        last = np.where(high + 1 < len(self.below), self.below[np.minimum(high + 1, len(self.below) - 1)], self.n)
        sought = (values & ((1 << self.low) - 1)).astype(np.uint64)
        open_ = np.flatnonzero(first < last)
        while len(open_):
            middle = (first[open_] + last[open_]) >> 1
            less = self.lows(middle) < sought[open_]
            first[open_] = np.where(less, middle + 1, first[open_])
            last[open_] = np.where(less, last[open_], middle)
            open_ = open_[first[open_] < last[open_]]
        return first

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where it is missing."""
        if not self.n:
            return np.full(len(values), -1)
        at = self.successor(values)
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self.access(inside) == values), at, -1)


class Level:
    """The n-grams of one order in one shard."""

    @staticmethod
    def encode(contexts: np.ndarray, places: np.ndarray, chances: np.ndarray, weights: np.ndarray) -> bytes:
        """From rows in ascending (context node, place of the word relative to it), and their codes."""
        new = np.flatnonzero(np.diff(contexts, prepend=-1))
        last = np.r_[new[1:], len(contexts)] - 1 if len(new) else new
        assert len(new) == len(weights) and len(contexts) == len(chances)
        base = np.r_[0, np.cumsum(places[last] + 1)[:-1]] if len(new) else new
        monotone = places + np.repeat(base, np.diff(np.r_[new, len(contexts)]))
        lists = [EliasFano.encode(v) for v in (contexts[new], np.r_[new, len(contexts)], monotone)]
        codes = chances.tobytes() + weights.tobytes()
        return b"".join(lists) + codes

    def __init__(self, raw: np.ndarray) -> None:
        self.contexts = EliasFano(raw, 0)
        self.pointers = EliasFano(raw, self.contexts.end)
        self.successors = EliasFano(raw, self.pointers.end)
        ends = self.successors.end + self.successors.n
        self.chances, self.weights = raw[self.successors.end : ends], raw[ends : ends + self.contexts.n]

    @staticmethod
    def codes(held: np.ndarray, at: np.ndarray, otherwise: int) -> np.ndarray:
        """Codes at places, another one for what is not there."""
        return np.r_[held, np.uint8(otherwise)][at]

    def search(self, contexts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the level of each n-gram and of its context (-1: not there), and where the context's range starts."""
        # The same context in a row is looked up once.
        new = np.flatnonzero(np.diff(contexts, prepend=-1))
        sizes = np.diff(np.r_[new, len(contexts)])
        of = self.contexts.find(contexts[new])
        start, stop, base = np.zeros((3, len(of)), np.int64)
        known = np.flatnonzero(of >= 0)
        if len(known):
            start[known], stop[known] = self.pointers.access(of[known]), self.pointers.access(of[known] + 1)
            base[known] = np.where(start[known] > 0, self.successors.access(np.maximum(start[known], 1) - 1) + 1, 0)
        found, first = self.successors.find(np.repeat(base, sizes) + places), np.repeat(start, sizes)
        # A context that is not there has an empty range.
        return np.where((found >= first) & (found < np.repeat(stop, sizes)), found, -1), np.repeat(of, sizes), first


# Blocks.


class Block:
    """Documents of a block, tokens by block-local number."""

    def __init__(self, uri: str) -> None:
        self.doc_ids, self.nulls, self.train, self.lengths, self.tokens, n = unsqueeze(get(uri))
        self.doc_ids, n = np.where(self.doc_ids & 1, -(self.doc_ids + 1) // 2, self.doc_ids // 2), int(n[0])
        # A document is start, words, end.
        ends = np.cumsum(self.lengths + 2)
        self.starts = ends - self.lengths - 2
        self.flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        inside = np.ones(len(self.flat), bool)
        inside[self.starts] = inside[ends - 1] = False
        self.flat[inside] = self.tokens
        self.flat[ends - 1], self.flat[self.starts] = n, n + 1
        self.size, self.scored = n + 2, self.flat != n + 1
        self.trained = np.repeat(self.train.astype(bool), self.lengths + 2) & self.scored

    @staticmethod
    def write(uri: str, doc_ids: list, train: list, lengths: np.ndarray, tokens: np.ndarray, n_words: int) -> None:
        ids = np.array([i or 0 for i in doc_ids], dtype=np.int64)
        nulls = np.array([i is None for i in doc_ids])
        put(uri, squeeze(_signed(ids), nulls, np.array(train), lengths, tokens, np.array([n_words])))

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For orders 2 to ``order``: of each distinct n-gram its context (n-gram of the order before), its shorter n-gram
        and its training count; and the n-gram at every token. N-gram 0 is the start of a document."""
        at, bits = self.flat, self.size.bit_length()
        for _ in range(2, order + 1):
            key = np.r_[0, at[:-1]] << bits
            key |= self.flat
            key[self.starts] = -1
            key, by = _sorted(key)
            new = np.flatnonzero(np.diff(key, prepend=-2))
            now = np.empty(len(key), np.int64)
            now[by] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(key)]))
            counts = np.add.reduceat(self.trained[by], new, dtype=np.int64)
            yield np.maximum(key[new], 0) >> bits, at[by[new]], counts, now
            at = now


class Known:
    """What a block knows of its n-grams of one order: chance (log10), count as a context, node, and the place among
    the successors of the shorter context, 0 if training has not seen the n-gram. Node 0 is a document's start."""

    def __init__(self, chance: np.ndarray, count: np.ndarray, node: np.ndarray, place: np.ndarray) -> None:
        self.chance, self.count, self.node, self.place = chance, count, node, place


class Plan:
    """Sizes and places that all tasks share."""

    def __init__(self, root: str, order: int, shards: int, tokens: int, documents: int, hot: int) -> None:
        self.root, self.order, self.shards, self.tokens, self.documents, self.hot = root, order, shards, tokens, documents, hot

    def block(self, block: int) -> str:
        return f"{self.root}/blocks/{block:012d}"

    def words(self, block: int) -> list[bytes]:
        """A block's words by number; they are kept until they have their places in the vocabulary."""
        raw = get(f"{self.root}/words/{block:012d}")
        return pa.Codec("zstd").decompress(raw[8:], int(np.frombuffer(raw, "<i8", 1)[0]), asbytes=True).split()

    def put_words(self, block: int, known: list[bytes]) -> None:
        text = b" ".join(known)
        packed = pa.Codec("zstd", compression_level=1).compress(text, asbytes=True)
        put(f"{self.root}/words/{block:012d}", np.array([len(text)], "<i8").tobytes() + packed)

    def words_dealt(self, block: int) -> str:
        return f"{self.root}/words/{block:012d}.dealt"

    def forget_words(self) -> None:
        store, path = _store(f"{self.root}/words")
        if store.get_file_info(path).type.name == "Directory":
            store.delete_dir(path)

    def told(self, block: int, order: int) -> str:
        return f"{self.root}/told{order}/{block:012d}"

    def level(self, order: int, shard: int) -> str:
        return f"{self.root}/order{order}/{shard:08d}"

    def dealt(self, node: np.ndarray, place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard of each n-gram, and the parts and part of its context's split."""
        home = _mixed(node)
        home -= home // self.shards * self.shards
        parts, part = np.ones(len(node), np.int64), np.zeros(len(node), np.int64)
        split = np.flatnonzero(count >= self.hot)
        if len(split):
            parts[split] = np.minimum(self.shards, 1 + count[split] // self.hot)
            part[split] = _mixed(place[split]) % parts[split]
            home[split] = (home[split] + part[split]) % self.shards
        return home, parts, part


class Asked:
    """The n-grams of one order that a block asks for: those whose context training has seen."""

    def __init__(self, plan: Plan, context: np.ndarray, shorter: np.ndarray, before: Known) -> None:
        rows = np.flatnonzero((before.count > 0)[context])
        rows = rows[rows > 0]  # n-gram 0 is a document's start
        # N-grams of a context lie together and go together; those of a split one go each for itself.
        at = context[rows]
        split = before.count >= plan.hot
        new = np.diff(at, prepend=-1) != 0
        if split.any():
            new |= split[at]
        new = np.flatnonzero(new)
        sizes, of = np.diff(np.r_[new, len(rows)]), at[new]
        node, count = before.node[of], before.count[of]
        shard, parts, part = plan.dealt(node, before.place[shorter[rows[new]]], count)
        # By shard, then by context: nodes travel as small steps. Rows of a context lie together, in an order of their own.
        turn = np.lexsort((node, shard)) if (parts > 1).any() else _order(shard, node)
        sizes = sizes[turn]
        self.rows = rows[_ranges(new[turn], sizes)]
        #: For each n-gram the number of its group, whose context's node, count, shard and split follow.
        self.group = np.repeat(np.arange(len(turn)), sizes)
        self.node, self.count, self.shard, self.parts, self.part = (a[turn] for a in (node, count, shard, parts, part))
        self.bounds = np.r_[0, np.cumsum(sizes)][np.searchsorted(self.shard, np.arange(plan.shards + 1))]


def _rows(kind: str, found: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*found)) or [()] * 3
    other = "block" if kind == "shard" else "shard"
    return pa.table(
        {kind: pa.array(columns[0], pa.int64()), other: pa.array(columns[1], pa.int64()), "body": pa.array(columns[2], pa.binary())}
    )


_TO_SHARD, _TO_BLOCK = "shard long, block long, body binary", "block long, shard long, body binary"


def _ask(plan: Plan, order: int) -> Callable:
    """Of a block: its distinct n-grams and their training counts, to the shards of their contexts."""

    @roomy
    def asked_of(block):
        own = Block(plan.block(block))
        grams = list(own.grams(order))
        before = _told(plan, order - 1, block, own, grams)
        context, shorter, counts, _ = grams[-1]
        asked = Asked(plan, context, shorter, before)
        counts, less, found = counts[asked.rows], shorter[asked.rows], []
        place, lower = before.place[less], quantised(before.chance)[less]
        node, count = asked.node[asked.group], asked.count[asked.group]
        for shard in range(plan.shards):
            part = slice(asked.bounds[shard], asked.bounds[shard + 1])
            columns = (_steps(node[part]), place[part], counts[part], _steps(count[part]), lower[part])
            found.append((shard, block, squeeze(*columns)))
        return _rows("shard", found)

    def run(batches):
        for batch in batches:
            for block in batch.column(0).to_pylist():
                yield from asked_of(block).to_batches()

    return run


def _answer(plan: Plan, order: int) -> Callable[[pa.Table], pa.Table]:
    """Of a shard: all blocks' requests to a level of the trie, and the level's answers."""

    @roomy
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blocks = table.column("block").to_pylist()
        parts = [unsqueeze(b) for b in table.column("body").to_pylist()]
        del table
        sizes = [len(p[0]) for p in parts]
        node = np.concatenate([_from_steps(p[0]) for p in parts])
        place, counts = (np.concatenate([p[c] for p in parts]) for c in (1, 2))
        of_context = np.concatenate([_from_steps(p[3]) for p in parts])
        lower = np.concatenate([p[4].astype(np.uint8) for p in parts])
        del parts
        by, first = _runs(node, place)
        which = np.empty(len(by), np.int64)
        which[by] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(by)]))
        total = np.add.reduceat(counts[by], first) if len(first) else first
        one = by[first]
        node, place, of_context, lower = node[one], place[one], of_context[one], lower[one]
        del by, first, counts
        seen = np.flatnonzero(total > 0)
        starts = np.flatnonzero(np.diff(node[seen], prepend=-1))
        sizes_of = np.diff(np.r_[starts, len(seen)])
        # Distinct successors, scaled from the part's occurrences to the context's.
        held = np.add.reduceat(total[seen], starts) if len(starts) else starts
        n = of_context[seen][starts]
        left = LEFT.get(order, LEFT_BEYOND) * sizes_of * n / np.maximum(held, 1)
        weights = quantised(np.log10(left / (n + left)))
        n, left = np.repeat(n, sizes_of), np.repeat(left, sizes_of)
        chance = (total[seen] + left * 10.0 ** (-lower[seen].astype(np.float64) / STEPS)) / (n + left)
        uri = plan.level(order, shard)
        put(uri, Level.encode(node[seen], place[seen], quantised(np.log10(np.minimum(chance, 1.0))), weights))
        level = Level(mapped(uri))
        at, of, start = level.search(node, place)
        columns = [level.codes(level.chances, at, UNSEEN), level.codes(level.weights, of, 0)]
        last, rank = order == plan.order, np.where(at >= 0, at - start, 0)
        found, done = [], 0
        for block, size in zip(blocks, sizes):
            some = which[done : done + size]
            done += size
            body = [c[some] for c in columns]
            if not last:
                body += [total[some], _steps(start[some]), rank[some]]
            found.append((block, shard, squeeze(*body)))
        return _rows("block", found)

    return run


def _learnt(plan: Plan, order: int, grams: tuple, before: Known, bodies: list[bytes]) -> Known:
    """What the answers of all shards tell a block."""
    context, shorter, _, _ = grams
    asked = Asked(plan, context, shorter, before)
    answers = [unsqueeze(b) for b in bodies]
    code, left, *more = (np.concatenate(c) for c in zip(*answers))
    known, n, rows = code < UNSEEN, len(context), asked.rows
    chance = before.chance[shorter]
    chance[rows] = np.where(known, -code / STEPS, chance[rows] - left / STEPS)
    count, node, place = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    if order < plan.order:
        starts = np.concatenate([_from_steps(a[3]) for a in answers])
        # What training has not seen has count 0, and its node is no context's.
        count[rows], rank = more[0], more[2]
        node[rows] = 1 + (starts + rank) * plan.shards + asked.shard[asked.group]
        # Places start at 1; those of a split context are told apart by the part.
        place[rows] = known * (1 + rank * asked.parts[asked.group] + asked.part[asked.group])
        count[0] = plan.documents  # n-gram 0 is the start of a document
    return Known(chance, count, node, place)


def _keep(plan: Plan, order: int) -> Callable[[pa.Table], pa.Table]:
    """Of a block: the answers of one order, kept beside it."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        bodies = [b for _, b in sorted(zip(table.column("shard").to_pylist(), table.column("body").to_pylist()))]
        if order == 1:
            raw = _vocabulary(plan, unsqueeze(get(plan.words_dealt(block)))[0], bodies)
        else:
            raw = np.array([len(bodies), *map(len, bodies)], "<i8").tobytes() + b"".join(bodies)
        put(plan.told(block, order), raw)
        return pa.table({"block": pa.array([block], pa.int64())})

    return run


def _vocabulary(plan: Plan, shard: np.ndarray, bodies: list[bytes]) -> bytes:
    """Counts and places of a block's words, and the number of distinct training words."""
    counts, place, distinct = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64), 0
    for s, (at, body) in enumerate(zip(_by_shard(shard, plan.shards), bodies, strict=True)):
        of, ranks, size = unsqueeze(body)
        counts[at], place[at] = of, np.where(of > 0, 2 + ranks * plan.shards + s, 0)
        distinct += int(size[0])
    return squeeze(counts, place, np.array([distinct]))


def _told(plan: Plan, order: int, block: int, own: Block, grams: list[tuple], bodies: list[bytes] | None = None) -> Known:
    """What a block knows up to an order, from the answers kept beside it and ``bodies`` for the last."""
    counts, place, distinct = unsqueeze(get(plan.told(block, 1)))
    there = int(plan.documents > 0)  # the end of a document
    counts, place = np.r_[counts, plan.documents, 0], np.r_[place, there, 0]
    chance = np.log10((counts + 0.5) / (plan.tokens + 0.5 * (int(distinct[0]) + there + 1)))
    as_context = counts.copy()
    as_context[own.size - 2 :] = 0, plan.documents
    known = Known(chance, as_context, place, place)
    for k in range(2, order + 1):
        if k == order and bodies is not None:
            some = bodies
        else:
            raw = get(plan.told(block, k))
            sizes = np.frombuffer(raw, "<i8", int(np.frombuffer(raw, "<i8", 1)[0]), 8)
            ends = 8 * (len(sizes) + 1) + np.cumsum(sizes)
            some = [raw[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist())]
        known = _learnt(plan, k, grams[k - 2], known, some)
    return known


def word_shards(some: list[bytes], shards: int) -> np.ndarray:
    return (_told_apart(some) % np.uint64(shards)).astype(np.int64)


def _told_apart(some: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some))


def _by_shard(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    """The places of each shard's entries, ascending."""
    by = np.argsort(shard, kind="stable")
    return np.split(by, np.searchsorted(shard[by], np.arange(1, shards)))


def _ask_words(plan: Plan) -> Callable:
    """Of a block: its words and their training counts, to the shards of the vocabulary."""

    def run(batches):
        for batch in batches:
            for block in batch.column(0).to_pylist():
                own, known = Block(plan.block(block)), plan.words(block)
                counts = np.bincount(own.flat[own.trained], minlength=own.size)[: len(known)]
                shard, some, found = word_shards(known, plan.shards), np.array(known, dtype=object), []
                put(plan.words_dealt(block), squeeze(shard))
                for s, at in enumerate(_by_shard(shard, plan.shards)):
                    text, body = b" ".join(some[at].tolist()), squeeze(counts[at])
                    packed = pa.Codec("zstd", compression_level=1).compress(text, asbytes=True)
                    found.append((s, block, np.array([len(text), len(body)], "<i8").tobytes() + body + packed))
                yield from _rows("shard", found).to_batches()

    return run


@roomy
def _answer_words(table: pa.Table) -> pa.Table:
    """Of a shard of the vocabulary: counts over all blocks, and ranks by falling count."""
    shard, blocks = table.column("shard")[0].as_py(), table.column("block").to_pylist()
    texts, counts = [], []
    for raw in table.column("body").to_pylist():
        size, head = np.frombuffer(raw, "<i8", 2).tolist()
        counts.append(unsqueeze(raw[16 : 16 + head])[0])
        texts.append(pa.Codec("zstd").decompress(raw[16 + head :], size, asbytes=True))
    sizes, lengths, text = words(pa.array(texts, pa.large_binary()))
    at, known = numbered(lengths, text)
    places = np.split(at, np.cumsum(sizes)[:-1])
    total = np.zeros(len(known), np.int64)
    for at, n in zip(places, counts, strict=True):
        total[at] += n
    rank = np.empty(len(known), np.int64)
    rank[np.lexsort((_told_apart(known), -total))] = np.arange(len(known))
    size = np.array([(total > 0).sum()])
    return _rows("block", [(b, shard, squeeze(total[at], rank[at], size)) for b, at in zip(blocks, places)])


_SCORES = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def _finish(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    """Of a block: the answers of the last order become scores."""

    @roomy
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        bodies = [b for _, b in sorted(zip(table.column("shard").to_pylist(), table.column("body").to_pylist()))]
        own = Block(plan.block(block))
        grams = list(own.grams(plan.order))
        words_ = _told(plan, 1, block, own, grams)
        last = _told(plan, plan.order, block, own, grams, bodies)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(np.where(own.scored, values, 0), own.starts)

        return pa.table(
            {
                "doc_id": pa.array(own.doc_ids, pa.int64(), mask=own.nulls.astype(bool)),
                "train": pa.array(own.train.astype(bool)),
                "n_tokens": pa.array(own.lengths + 1, pa.int64()),
                "n_known": pa.array(summed(words_.place[own.flat] > 0).astype(np.int64)),
                "base_score": pa.array(summed(words_.chance[own.flat])),
                "score": pa.array(summed(last.chance[grams[-1][3]])),
            }
        )

    return run


def _cut(plan: Plan, size: int, train: Column, docs: DataFrame) -> DataFrame:
    """Writes the blocks; a row for each."""

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        doc_ids, flags, sizes, lengths, texts, held = [], [], [], [], [], 0

        def flush():
            nonlocal doc_ids, flags, sizes, lengths, texts, held, count
            number = part << 20 | count
            tokens, known = numbered(np.concatenate(lengths), b"".join(texts))
            n_words, trained = np.concatenate(sizes), np.array(flags)
            Block.write(plan.block(number), doc_ids, flags, n_words, tokens, len(known))
            plan.put_words(number, known)
            values = [number, held, int((n_words + 1)[trained].sum()), int(trained.sum())]
            doc_ids, flags, sizes, lengths, texts, held, count = [], [], [], [], [], 0, count + 1
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=["block", "tokens", "trained", "documents"])

        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                ids, train_, some = batch.slice(k, 500).columns
                ids, train_ = ids.to_pylist(), train_.to_pylist()
                n_words, n_bytes, text = words(some)
                # Words, bytes and tokens before each document.
                at = np.r_[0, np.cumsum(n_words)]
                within = np.r_[0, np.cumsum(n_bytes)][at]
                before, done = at + np.arange(len(at)), 0
                while done < len(ids):
                    # Up to the document that fills the block.
                    end = min(int(np.searchsorted(before, before[done] + size - held)), len(ids))
                    end = max(end, done + 1)
                    doc_ids += ids[done:end]
                    flags += train_[done:end]
                    sizes.append(n_words[done:end])
                    lengths.append(n_bytes[at[done] : at[end]])
                    texts.append(text[within[done] : within[end]])
                    held += int(before[end] - before[done])
                    if held >= size:
                        yield flush()
                    done = end
        if doc_ids:
            yield flush()

    text = F.col("text").cast("string").cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), train.alias("train"), text.alias("text"))
    return rows.mapInArrow(run, "block long, tokens long, trained long, documents long")


def _release(spark) -> None:
    """Let go of the shuffle files of a pass that has ended: Spark drops them when the driver collects its garbage,
    and py4j lets go of the plan a moment after Python has."""
    for _ in range(3):
        gc.collect()
        time.sleep(RELEASE_SECONDS)
        spark.sparkContext._jvm.System.gc()


def score_documents(
    docs: DataFrame, order: int = ORDER, block: int = BLOCK, shard: int = SHARD, hot: int = HOT, train: Column | None = None
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score of every document.

    The model learns from rows where ``train`` (a column of doc_id; the fold by default) holds.
    """
    has_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    plan = Plan(scratch_dir(spark, "language-model"), order, 1, 0, 0, hot)
    blocks = written(_cut(plan, block, ~held_out(F.col("doc_id")) if train is None else train, docs), "blocks")
    total = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "trained", "documents")]).first()
    plan = Plan(plan.root, order, max(1, ceil(total["tokens"] / shard)), total["trained"], total["documents"], hot)
    numbers = blocks.select("block").repartitionByRange(max(1, blocks.count()), "block")
    rows = None
    for k in range(1, order + 1):
        ask, answer = (_ask_words(plan), _answer_words) if k == 1 else (_ask(plan, k), _answer(plan, k))
        rows = numbers.mapInArrow(ask, _TO_SHARD).groupBy("shard").applyInArrow(answer, _TO_BLOCK).groupBy("block")
        if k < order:
            rows.applyInArrow(_keep(plan, k), "block long").count()
            rows = None
            if k == 1:
                plan.forget_words()
            _release(spark)
    rows = rows.applyInArrow(_finish(plan), _SCORES)
    return written(rows, "scores").withColumn("train_tokens", F.lit(plan.tokens).cast("long"))


def op12_lm_scoring(spark, sf_dir):
    """log10 probability of every document by trigrams of the training folds."""
    out = score_documents(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
